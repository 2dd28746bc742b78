"""showgrain: a Spark-first engine for venue-event feeds and the text that comes with them."""

__version__ = "0.1.0"
