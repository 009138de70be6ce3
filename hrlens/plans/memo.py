"""Per-session memo of fitted models shared by several query keys.

Keys are (Spark application id, data folder, what); ``clear()`` drops all of
them (the benchmark clears before every timed run so each run fits anew).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_MEMO: dict = {}


def memo(spark, sf_dir: str, what, build: Callable[[], Any]) -> Any:
    k = (spark.sparkContext.applicationId, sf_dir, what)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def clear() -> None:
    _MEMO.clear()
