"""Batch inference hook (G2) and the optional exact token gate.

The model is a user function ``prompts: list[str] -> responses: list[str]`` built by a
zero-argument factory.  It runs inside ``mapInArrow``, and only the prompts of one model call
are Python strings at a time: each call of
``infer`` has an id of its own, under which a Python worker builds its model once and
keeps it for the call's later tasks.  A failing batch is retried row by row; a row whose
call fails gets a null response and the error's text, so one bad note never fails the job
and none fails silently.  Only the request id and prompt cross into Python.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Models of a worker by call id; the least recently used one makes room.
_MODELS: OrderedDict[str, Callable] = OrderedDict()
_MOST_MODELS = 4
ERROR = "error"


def _model(call: str, factory: Callable[[], Callable]) -> Callable:
    if call not in _MODELS:
        _MODELS[call] = factory()
        while len(_MODELS) > _MOST_MODELS:
            _MODELS.popitem(last=False)
    _MODELS.move_to_end(call)
    return _MODELS[call]


def _call(model: Callable, prompts: list[str]) -> list[tuple[object, str | None]]:
    """``(response, error)`` of each prompt."""
    try:
        out = list(model(prompts))
        if len(out) == len(prompts):
            return [(r, None) for r in out]
    except Exception:  # each row is tried alone below, and keeps its own error
        pass
    results: list[tuple[object, str | None]] = []
    for p in prompts:
        try:
            results.append((list(model([p]))[0], None))
        except Exception as e:
            results.append((None, f"{type(e).__name__}: {e}"))
    return results


def infer(requests: DataFrame, id_cols: list[str], prompt_col: str, model_factory: Callable[[], Callable],
          out_col: str = "response", batch_rows: int = 32) -> DataFrame:
    """``id_cols`` of each request row plus ``out_col`` and ``error`` (strings; a response is
    null on error, an error null otherwise).

    ``batch_rows`` prompts go to the model per call.
    """
    schema = T.StructType([requests.schema[c] for c in id_cols] + [
        T.StructField(out_col, T.StringType(), True), T.StructField(ERROR, T.StringType(), True)])
    call = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(call, model_factory)
        for batch in batches:
            prompts = batch.column(len(id_cols))
            answers = [a for i in range(0, len(prompts), batch_rows)
                       for a in _call(model, [p or "" for p in prompts.slice(i, batch_rows).to_pylist()])]
            told = [pa.array([a[k] for a in answers], pa.string(), from_pandas=True) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(id_cols)], *told], names=[*id_cols, out_col, ERROR])

    return requests.select(*id_cols, prompt_col).mapInArrow(run, schema)


def token_counts(prompts: DataFrame, prompt_col: str, counter_factory: Callable[[], Callable],
                 out_col: str = "n_tokens", batch_rows: int = 32) -> DataFrame:
    """``prompts`` with the exact token count of each prompt by a user tokenizer
    (``list[str] -> list[int]``), which is given ``batch_rows`` prompts a call."""
    schema = T.StructType([*prompts.schema.fields, T.StructField(out_col, T.LongType(), True)])
    call = uuid.uuid4().hex

    at = prompts.columns.index(prompt_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _model(call, counter_factory)
        for batch in batches:
            texts = batch.column(at)
            counts = [int(n) for i in range(0, len(texts), batch_rows) for n in counter(texts.slice(i, batch_rows).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, out_col])

    return prompts.mapInArrow(run, schema)
