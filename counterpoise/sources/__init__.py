"""Sources and sinks: labelled frames from the driver's tables, KEEL and CSV text, metric sinks."""

from counterpoise.sources.tables import table, lp_emb, lp_orders, lp_quality, lp_toxic, FRAMES  # noqa: F401
