"""Arrow-batched helpers declared at import time, bound to Spark when first used."""

from __future__ import annotations

from pyspark.sql import functions as F


def batch_udf(return_type: str, kind: str = "pandas_udf"):
    """Like ``pandas_udf``, or another kind of batches, but needs no running session at import.

    Marked nondeterministic so that the optimizer computes it once per row and never copies the call
    into the lambda functions that read its result.
    """

    def wrap(function):
        def call(*columns):
            return getattr(F, kind)(function, return_type).asNondeterministic()(*columns)

        call.__doc__ = function.__doc__
        return call

    return wrap


def arrow_udf(return_type: str):
    """The same on Arrow arrays."""
    return batch_udf(return_type, "arrow_udf")
