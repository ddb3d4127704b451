"""hearth: Spark-native valuation of listing tables.

DataFrames and Spark SQL do the relational work, MLlib fits the tree models,
and the linear family is cross-validated from per-fold sufficient statistics
gathered in one distributed pass (see ``operators.gram``).
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions and classes of this package that end up inside Python UDF
    closures are pickled by value, so executors need not have it installed."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
