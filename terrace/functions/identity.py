"""Record identity, change-detection and surrogate-key expressions.

All are Catalyst built-ins (``sha2``, ``to_json``, ``xxhash64``) so they run
inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that identities depend on.
RECORD_ID_SEPARATOR = "||"
SIGN_MASK = 0x7FFFFFFFFFFFFFFF


def _cols(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def record_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of the JSON text of the source-shaped row.

    ``to_json`` leaves NULL fields out, but the field names of the present
    values are part of the text, so two rows hash equal only when the same
    fields hold the same values.
    """
    return F.sha2(F.to_json(F.struct(*_cols(columns))), 256)


def record_id(source_file: str | Column, row_hash: str | Column) -> Column:
    """Bronze record identity: SHA-256 of ``source file || record hash``."""
    return F.sha2(F.concat_ws(RECORD_ID_SEPARATOR, _cols([source_file])[0], _cols([row_hash])[0]), 256)


def attribute_hash(columns: Sequence[str | Column]) -> Column:
    """Change-detection hash over descriptive attributes.

    The pre-image is JSON with NULL fields kept, so ``('a', NULL, 'b')`` and
    ``('a', 'b', NULL)`` differ and a value containing a separator cannot
    imitate two values (a plain ``concat_ws`` pre-image has both faults).
    """
    return F.sha2(F.to_json(F.struct(*_cols(columns)), {"ignoreNullFields": "false"}), 256)


def surrogate_key(column: str | Column) -> Column:
    """Non-negative 63-bit key from ``xxhash64`` of the natural key.

    The sign bit is masked instead of taking ``abs``: ``abs(Long.MinValue)``
    raises under ANSI mode and ``abs`` folds two hashes onto one key.
    """
    return F.xxhash64(_cols([column])[0]).bitwiseAND(F.lit(SIGN_MASK))
