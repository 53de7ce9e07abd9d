"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def slice_text(value: Column | str, begin: int, end: int) -> Column:
    """Characters [begin, end), 0-based; a short input gives what exists."""
    return F.substring(_col(value), begin + 1, end - begin)


def slice_encoded(raw: Column, begin: int, end: int, charset: str = "GBK") -> Column:
    """Bytes [begin, end) of encoded text, decoded and trimmed; NULL when it ends before ``end``.

    GBK needs ``session.gbk_session``.
    """
    part = F.trim(F.decode(F.substring(raw, begin + 1, end - begin), charset))
    return F.when(F.octet_length(raw) >= end, part)


def pieces(line: Column | str) -> Column:
    """Split on the pipe; trailing empty pieces are dropped."""
    return F.split(F.regexp_replace(_col(line), r"\|+$", ""), r"\|")


def text_or_blank(value: Column | str) -> Column:
    """NULL and the text ``null`` become empty text."""
    text = F.coalesce(_col(value), F.lit(""))
    return F.when(text == "null", F.lit("")).otherwise(text)


def is_blank(value: Column | str) -> Column:
    """True for NULL, white space and the text ``null``."""
    return F.coalesce(F.trim(_col(value)), F.lit("")).isin("", "null")


def key_of(*parts: Column | str, sep: str) -> Column:
    """Composite text key; missing parts count as empty text."""
    return F.concat_ws(sep, *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def contains_item(joined: Column | str, item: str, sep: str = ",") -> Column:
    """Is ``item`` one of the pieces of ``joined``?"""
    return F.array_contains(F.split(_col(joined), sep), item)


def label_value(label: Column | str, value: Column | str, sep: str = ", ") -> Column:
    """``label, value`` as one line of text."""
    return F.concat_ws(sep, _col(label), _col(value).cast("string"))


def describe(columns: Iterable[str]) -> Column:
    """``name:value`` of every column, space separated (log line of a record)."""
    return F.concat_ws(" ", *[
        F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns])


def decode_list(text: Column | str) -> Column:
    """Translate ``"v,s1,r1,s2,r2,...,default"`` to an integer.

    The last matching pair wins; without a match the last piece is the result.
    """
    def result(parts: Column) -> Column:
        wanted = F.trim(F.element_at(parts, 1))
        # Pairs start at 0-based odd positions; the last piece never starts a pair.
        starts = F.when(F.size(parts) >= 3, F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2))).otherwise(
            F.array().cast("array<int>"))
        hits = F.filter(starts, lambda i: F.trim(F.get(parts, i)) == wanted)
        return F.coalesce(F.get(parts, F.try_element_at(hits, F.lit(-1)) + 1), F.element_at(parts, -1))

    # The outer transform binds the pieces to a name, so the text is split once.
    split = F.array(F.split(F.regexp_replace(_col(text), ",+$", ""), ","))
    return F.get(F.transform(split, result), F.lit(0)).try_cast("int")


def decode_list_sql(arg: str) -> str:
    """The same rule as SQL text, for registration as a SQL function."""
    parts = "p"
    starts = (f"CASE WHEN size({parts}) >= 3 THEN sequence(1, size({parts}) - 2, 2) "
              "ELSE CAST(array() AS ARRAY<INT>) END")
    hits = f"filter({starts}, i -> trim(get({parts}, i)) = trim(element_at({parts}, 1)))"
    result = f"coalesce(get({parts}, try_element_at({hits}, -1) + 1), element_at({parts}, -1))"
    return f"try_cast(get(transform(array(split(regexp_replace({arg}, ',+$', ''), ',')), p -> {result}), 0) AS INT)"
