"""User-function surface (X1, X2): the only place Python workers run.

``translate_batches`` keeps batching, request building and realignment native
and hands only the merged request texts to the user function, through
``mapInArrow`` (the function's resources opened once per partition by
``setup``). The other columns stay Arrow arrays, and a batch is answered a few
requests at a time, so a Python worker holds no more than a batch at any size.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from parcorpus.functions import text as T
from parcorpus.operators import batching

#: Requests whose answers a Python worker holds at a time.
REQUESTS_AT_ONCE = 100


def translate_requests(requests: DataFrame, fn: Callable[[str], object],
                       attempts: int = 3, setup: Callable[[], object] | None = None,
                       col: str = "translated") -> DataFrame:
    """Apply ``fn`` to every request text with retries. A string answer is kept
    as is, two lists (sources, targets), in a tuple or a list, become ``pairs``;
    ``None`` means not found; an answer of any other kind, and exhausted attempts,
    mean failed (both become status markers).

    The function shipped to the Python workers is a closure over plain values
    only, so executors need nothing but the user's ``fn``.
    """
    not_found, failed = T.MARKER_NOT_FOUND, T.MARKER_FAILED
    tries = max(1, attempts)
    pair_t = ArrayType(StructType([StructField("sl", StringType()), StructField("tl", StringType())]))
    out_schema = StructType(list(requests.schema.fields)
                            + [StructField(col, StringType()), StructField("pairs", pair_t)])

    def apply_one(text):
        for _ in range(tries):
            try:
                out = fn(text)
            except Exception:  # noqa: BLE001 - any failure becomes a status tag
                continue
            if out is None:
                return f"{not_found} - {text}"
            if isinstance(out, str):
                return out
            if isinstance(out, (tuple, list)) and len(out) == 2 and all(
                    isinstance(side, (tuple, list)) and all(x is None or isinstance(x, str) for x in side) for side in out):
                return [((a or "").strip(), (b or "").strip()) for a, b in zip(*out)]
            break
        return f"{failed} - {text}"

    names, at_once = requests.columns, REQUESTS_AT_ONCE

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("sl", pa.string()), ("tl", pa.string())]))
        if setup is not None:
            setup()
        for batch in batches:
            for begin in range(0, batch.num_rows, at_once):
                part = batch.slice(begin, at_once)
                res = [apply_one(t) for t in part.column("request").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([r if isinstance(r, str) else None for r in res], pa.string()),
                     pa.array([None if isinstance(r, str) else r for r in res], kind)], [*names, col, "pairs"])

    return requests.mapInArrow(run, out_schema)


def translate_batches(df: DataFrame, fn: Callable[[str], str | None], sl: str = "sl",
                      ol: str = "ol", order="pos", attempts: int = 3,
                      seed: int = 42) -> DataFrame:
    """T6 batches -> T7 requests -> user function -> T8 realigned rows."""
    batches = batching.make_batches(df, order, seed=seed)
    requests = batching.make_requests(batches, sl, ol, seed=seed)
    return batching.realign(translate_requests(requests, fn, attempts))


def map_batched(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Vectorised batch map for logic with no native form."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)
