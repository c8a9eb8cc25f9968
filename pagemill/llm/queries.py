"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .hnsw import op10_hnsw
from .langid import op6_langid
from .media import op9_media
from .mixing import op4_mixing, op4_sql
from .packing import op7_packing
from .pii import op8_pii
from .quality import op1_quality
from .sharding import op2_sharding
from .simhash import op3_simhash
from .urlfilter import op5_sql, op5_urlfilter

_ALL = (op1_quality, op2_sharding, op3_simhash, op4_mixing, op5_urlfilter, op6_langid, op7_packing, op8_pii, op9_media, op10_hnsw)


def queries() -> dict:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": op4_sql(), "op5_urlfilter": op5_sql()}
