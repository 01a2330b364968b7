"""quarry: data-mining operators (baskets, text, sampling, encoding, neighbours, evaluation) as Spark jobs."""

from quarry.session import get_spark

__all__ = ["get_spark"]
