"""Providers of what a model or service computes, with offline ones that need neither.

A provider is a function of a DataFrame; services are called in
``mapInPandas`` batches within tasks. Keys come from the environment only.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def secret(name: str, conf: dict[str, str] | None = None) -> str | None:
    """A key from the environment, else from ``conf``; never stored."""
    return os.environ.get(name) or (conf or {}).get(name)


def hashed_embedding(text: Column, dim: int = 1024) -> Column:
    """Offline stand-in for an embedding: signed counts of hashed terms, of unit length; all zero without terms.

    Terms are cut and hashed in the JVM, the counts of a batch are one ``bincount``.
    """
    from lectern.functions.text import terms_of

    @F.pandas_udf("array<float>")
    def counts(hashes: pd.Series) -> pd.Series:
        out: list = []
        for at in range(0, len(hashes), 1024):
            some = [np.asarray(h, np.int64) for h in hashes.iloc[at : at + 1024]]
            flat = np.concatenate(some)
            row = np.repeat(np.arange(len(some)), [len(h) for h in some])
            x = np.bincount(row * dim + flat % dim, np.where(flat < 0, -1.0, 1.0), len(some) * dim).reshape(-1, dim)
            length = np.linalg.norm(x, axis=1, keepdims=True)
            out += list((x / np.where(length > 0, length, 1)).astype(np.float32))
        return pd.Series(out, dtype=object)

    return counts(F.transform(terms_of(F.coalesce(text, F.lit(""))), lambda t: F.xxhash64(t)))


def in_batches(df: DataFrame, column: str, out: str, call: Callable[[list], list], out_type: str, size: int = 10, errors: str | None = None) -> DataFrame:
    """``df`` and ``out``: what ``call`` gives for lists of at most ``size`` values, in their order.

    With ``errors`` a call that raises or gives another number of results fails
    no task: its values are tried one by one, and those that fail again have a
    null ``out`` and the message in the column ``errors`` (null elsewhere), so
    that they can be kept apart and tried later. Without it the task fails.
    """

    def once(values: list) -> list:
        got = list(call(values))
        if len(got) != len(values):
            raise ValueError(f"{len(got)} results for {len(values)} values")
        return got

    def alone(value: object) -> tuple:
        try:
            return once([value])[0], None
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got: list[tuple] = []
            values = b[column].tolist()
            for i in range(0, len(values), size):
                some = values[i : i + size]
                try:
                    got += [(x, None) for x in once(some)]
                except Exception:
                    if errors is None:
                        raise
                    got += [alone(x) for x in some]
            new = {out: pd.Series([x for x, _ in got], index=b.index, dtype=object)}
            if errors is not None:
                new[errors] = pd.Series([e for _, e in got], index=b.index, dtype=object)
            yield b.assign(**new)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    more = f", `{errors}` string" if errors is not None else ""
    return df.mapInPandas(run, f"{schema}, `{out}` {out_type}{more}")


def numbered(lines: Column) -> Column:
    """A prompt's numbered lines from an array of texts, from 0."""
    return F.concat_ws("\n", F.transform(lines, lambda x, j: F.concat(j.cast("string"), F.lit(". "), x)))


CORRECTIONS = "struct<corrections:array<struct<wrong:string,right:string>>>"
BREAKS = "struct<breaks:array<int>>"
TITLE = "struct<title:string,terms:array<string>>"


def reply(body: Column, schema: str) -> Column:
    """A model's JSON reply; null fields where it can't be read."""
    return F.from_json(body, schema, {"mode": "PERMISSIVE"})
