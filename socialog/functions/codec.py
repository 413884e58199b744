"""Text forms of binary ids, cast ids, mentions and embeds, and the way back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and embed templates of the flat text columns.
MENTION_SEPARATOR = ","
EMBED_SEPARATOR = "|"
CAST_EMBED = '{ "castId": { "fid": "%s", "hash": "%s" } }'
URL_EMBED = '{ "url": "%s" }'

# The same templates as patterns, and the place between two embeds.
CAST_PATTERN = r'^\{ "castId": \{ "fid": "(\d+)", "hash": "(\w*)" \} \}$'
URL_PATTERN = r'(?s)^\{ "url": "(.*)" \}$'
EMBED_BREAK = r'(?<= \})\|(?=\{ "(?:url|castId)": )'


def or_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0)).cast("long")


def or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def plain_hex(value: Column) -> Column:
    """Lower-case hex without prefix; absent or empty gives ``""``."""
    return or_blank(F.lower(F.hex(value)))


def hex_text(value: Column) -> Column:
    """Lower-case hex with ``0x``; absent or empty gives ``""``."""
    return F.when(F.length(value) > 0, F.concat(F.lit("0x"), F.lower(F.hex(value)))).otherwise("")


def from_hex(text: Column) -> Column:
    """Binary value of a ``0x`` text, NULL for ``""``."""
    return F.unhex(F.regexp_replace(or_null(text), "^0x", ""))


def cast_id_text(cast_id: Column) -> Column:
    """``fid:0xhash``; an absent id gives ``""``."""
    return F.when(
        cast_id.isNotNull(),
        F.concat(
            or_zero(cast_id["fid"]).cast("string"), F.lit(":"), hex_text(cast_id["hash"])
        ),
    ).otherwise("")


def mentions_text(mentions: Column) -> Column:
    return or_blank(F.array_join(mentions, MENTION_SEPARATOR))


def _fill(template: str, *values: Column) -> Column:
    """``template`` with each ``%s`` replaced by a value, as one concat."""
    first, *rest = template.split("%s")
    pieces = [F.lit(first)]
    for value, text in zip(values, rest, strict=True):
        pieces += [value, F.lit(text)]
    return F.concat(*pieces)


def embed_text(embed: Column) -> Column:
    """One embed; a cast id wins over a URL."""
    cast_id = embed["cast_id"]
    return (
        F.when(
            cast_id.isNotNull(),
            _fill(CAST_EMBED, or_zero(cast_id["fid"]).cast("string"), hex_text(cast_id["hash"])),
        )
        .when(F.length(embed["url"]) > 0, _fill(URL_EMBED, embed["url"]))
        .otherwise("")
    )


def embeds_text(embeds: Column) -> Column:
    return or_blank(F.array_join(F.transform(embeds, embed_text), EMBED_SEPARATOR))


def parse_cast_id(text: Column) -> Column:
    """``fid:0xhash`` back to a struct, NULL for ``""``; a bad number reads NULL."""
    return F.when(
        F.length(text) > 0,
        F.struct(
            F.substring_index(text, ":", 1).try_cast("bigint").alias("fid"),
            F.substring_index(text, ":", -1).alias("hash"),
        ),
    )


def parse_mentions(text: Column) -> Column:
    """Comma text back to an array of ids; ``""`` gives an empty array."""
    ids = F.transform(F.split(text, MENTION_SEPARATOR), lambda part: part.try_cast("bigint"))
    return F.when(F.length(text) > 0, ids).otherwise(F.array().cast("array<bigint>"))


def parse_embeds(text: Column) -> Column:
    """Embed text back to an array of ``{url, castId{fid, hash}}``.

    The text is not escaped, so it is cut at its templates and not read as
    JSON: quotes, backslashes and separators inside a URL stay as they are.
    """
    parts = F.split(text, EMBED_BREAK)

    def embed(part: Column) -> Column:
        fid = or_null(F.regexp_extract(part, CAST_PATTERN, 1)).try_cast("bigint")
        cast_id = F.struct(fid.alias("fid"), F.regexp_extract(part, CAST_PATTERN, 2).alias("hash"))
        return F.struct(
            or_null(F.regexp_extract(part, URL_PATTERN, 1)).alias("url"),
            F.when(fid.isNotNull(), cast_id).alias("castId"),
        )

    empty = F.array().cast("array<struct<url: string, castId: struct<fid: bigint, hash: string>>>")
    return F.when(F.length(text) > 0, F.transform(parts, embed)).otherwise(empty)
