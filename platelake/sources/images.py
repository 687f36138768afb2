"""Decoding and encoding images: .npy and uncompressed TIFF here, other formats by Pillow where it is installed."""

from __future__ import annotations

import io
import os
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode(data: bytes) -> np.ndarray:
    """The pixels of an image file, 2-D for grey images."""
    if data[:6] == b"\x93NUMPY":
        return np.load(io.BytesIO(data), allow_pickle=False)
    if data[:4] in (b"II*\0", b"MM\0*"):
        found = _read_tiff(data)
        if found is not None:
            return found
    try:
        from PIL import Image
    except ImportError as e:
        raise ValueError("this image format needs Pillow") from e
    return np.asarray(Image.open(io.BytesIO(data)))


def _read_tiff(data: bytes) -> np.ndarray | None:
    """Uncompressed TIFF, grey or of several samples a pixel side by side; None for anything else."""
    order = "<" if data[:2] == b"II" else ">"
    # Field types of the format and their sizes.
    sizes = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}
    at = struct.unpack_from(order + "I", data, 4)[0]
    tags: dict[int, list[int]] = {}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if kind in sizes:
            code, size = sizes[kind]
            place = at + 10 + 12 * k
            if n * size > 4:
                place = struct.unpack_from(order + "I", data, place)[0]
            tags[tag] = list(struct.unpack_from(f"{order}{n}{code}", data, place))
    width, height, bits = tags[256][0], tags[257][0], tags.get(258, [1])
    samples = tags.get(277, [1])[0]
    if tags.get(259, [1])[0] != 1 or len(set(bits)) != 1 or bits[0] not in (8, 16, 32) or (samples > 1 and tags.get(284, [1])[0] != 1) or tags.get(262, [1])[0] not in (1, 2):
        return None
    kind = {2: "i", 3: "f"}.get(tags.get(339, [1])[0], "u")
    body = b"".join(data[o : o + n] for o, n in zip(tags[273], tags[279]))
    shape = (height, width) if samples == 1 else (height, width, samples)
    return np.frombuffer(body, f"{order}{kind}{bits[0] // 8}", width * height * samples).reshape(shape).astype(f"{kind}{bits[0] // 8}")


def encode_tiff(pixels: np.ndarray) -> bytes:
    """An uncompressed TIFF, grey or colour, of whole numbers with or without sign or of 32-bit floats."""
    a = np.ascontiguousarray(pixels)
    if a.dtype.kind not in "uif" or a.dtype.itemsize > 4 or a.ndim not in (2, 3):
        raise ValueError(f"no TIFF of {a.ndim} dimensions of {a.dtype}")
    samples = a.shape[2] if a.ndim == 3 else 1
    bits = a.dtype.itemsize * 8
    body = a.astype(a.dtype.newbyteorder("<")).tobytes()
    body += b"\0" * (len(body) % 2)
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    colour = 2 if samples >= 3 else 1
    # Two values of a short field stand in its entry, more of them behind the pixels.
    lists = {258: [bits] * samples, 339: [kind] * samples} | ({338: [0] * (samples - (3 if colour == 2 else 1))} if samples not in (1, 3) else {})
    entries: list[tuple[int, int, list[int]]] = [(256, 4, [a.shape[1]]), (257, 4, [a.shape[0]]), (259, 3, [1]), (262, 3, [colour]), (273, 4, [8]), (277, 3, [samples]), (278, 4, [a.shape[0]]), (279, 4, [a.nbytes]), (284, 3, [1]), *((t, 3, v) for t, v in lists.items())]
    extra, packed = b"", b""
    for tag, k, values in sorted(entries):
        field = struct.pack(f"<{len(values)}{'H' if k == 3 else 'I'}", *values)
        if len(field) > 4:
            field, extra = struct.pack("<I", 8 + len(body) + len(extra)), extra + field + b"\0" * (len(field) % 2)
        packed += struct.pack("<HHI", tag, k, len(values)) + field.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", 8 + len(body) + len(extra)) + body + extra + struct.pack("<H", len(entries)) + packed + struct.pack("<I", 0)


def map_images(files: DataFrame, f: Callable[[np.ndarray], np.ndarray], path: Callable[[str], str] = lambda p: p) -> DataFrame:
    """path, content and error: every decoded image of files (path, content) through f, as TIFF; a broken one has an error and no content."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for p, data in zip(pdf["path"], pdf["content"]):
                try:
                    out.append((path(p), encode_tiff(f(decode(data))), None))
                except Exception as e:
                    out.append((path(p), None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "content", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, content binary, error string")


def load_arrays(files: DataFrame, most: int = 64) -> dict[str, np.ndarray]:
    """Illumination arrays by file name; at most `most` of them, one a channel, so that they may be broadcast."""
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} illumination arrays")
    return {r["name"]: decode(bytes(r["content"])) for r in rows}


def illumination_of(arrays: dict[str, np.ndarray], channel: str) -> np.ndarray | None:
    """The array of a channel under either of its names, None if there is none."""
    return arrays.get(f"{channel}_illum.npy", arrays.get(f"Illum{channel}.npy"))


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write content to root/path for each row of files (path, content) without error; path, bytes and error of each.

    root is a folder that every executor mounts. A file is written under another name and renamed, so that a task which runs
    again replaces whole files. The writing happens when the result is used, once: store it or count it."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for p, data in zip(pdf["path"], pdf["content"]):
                try:
                    target = os.path.join(root, p.removeprefix("file:").lstrip("/"))
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    part = f"{target}.{uuid.uuid4().hex}.part"
                    with open(part, "wb") as f:
                        f.write(data)
                    os.replace(part, target)
                    out.append((p, len(data), None))
                except OSError as e:
                    out.append((p, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "bytes", "error"])

    return files.filter("content IS NOT NULL").select("path", "content").mapInPandas(run, "path string, bytes long, error string")
