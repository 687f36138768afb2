"""platelake: cell-profiling analytics expressed as Spark plans."""
