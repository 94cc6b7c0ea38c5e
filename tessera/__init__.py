"""tessera: a Spark-native text-corpus engine (clean, dedup, tokenise, pack, plan)."""

__version__ = "0.1.0"
