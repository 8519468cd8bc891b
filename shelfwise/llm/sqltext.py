"""DuckDB SQL fragments shared by the checks of several operators."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of a VARCHAR expression, as an unsigned number (polynomial 0xEDB88320)."""
    data = (f"list_transform(range(0, strlen({text})), lambda i: "
            f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))")
    eight = ("list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda e, z: "
             "CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END)")
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda c, b: {eight}), 4294967295)"


LOWER_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
