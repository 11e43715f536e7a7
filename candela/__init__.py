"""candela: daily equity analytics (indicators, signals, returns, keyed
incremental loads and analyst queries) expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
