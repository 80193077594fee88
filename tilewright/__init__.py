"""tilewright: tile-coverage analytics and large-scale data operators on PySpark."""

__version__ = "0.1.0"
