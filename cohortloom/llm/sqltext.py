"""Pieces of oracle SQL that several operators need."""

from __future__ import annotations

#: CTE ``crc_table(t)``: one row with the 256 entries of the CRC-32 table, made by its own rule.
CRC_TABLE = """crc_steps AS (
  SELECT i, 0 AS k, i::UBIGINT AS v FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8)"""


def crc32(value: str, table: str = "t") -> str:
    """The unsigned CRC-32 of a number's decimal text; ``table`` is crc_table's column, in scope by a join."""
    codes = f"list_transform(string_split(({value})::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: xor(a // 256, {table}[(xor(a, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT)"
