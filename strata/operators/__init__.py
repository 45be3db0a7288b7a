"""DataFrame -> DataFrame operators, grouped by subject."""

from strata.operators import commerce, envelope, medallion, metrics, model, privacy, quality

__all__ = ["commerce", "envelope", "medallion", "metrics", "model", "privacy", "quality"]
