"""vellum: multi-level document datasets, labels and taxonomies as lazy Spark plans."""

__version__ = "0.1.0"
