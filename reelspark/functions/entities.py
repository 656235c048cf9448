"""Character references of HTML text, resolved in one pass as column expressions.

Named references come from the standard library's full table.  A name is looked up in one of `_BUCKETS`
small maps, chosen by its checksum; a name that is in none of them may begin with one of the old names that
need no semicolon, and the longest counts.  Numbers follow the standard's repairs.
"""
from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_BUCKETS = 256
#: What follows an ampersand, as the standard library reads it.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
BARE_NAME = "^(" + "|".join(BARE) + ")"
#: Numbers 128 to 159 mean characters of code page 1252; its five gaps stay as they are.
C1 = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))


def _table() -> Column:
    maps: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, chars in html5.items():
        maps[zlib.crc32(name.encode()) % _BUCKETS][name] = chars
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")


def _char(n: Column) -> Column:
    """Character of a number that a reference names."""
    last = n % 0x10000
    missing = (n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | last.isin(0xFFFE, 0xFFFF))
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�")
            .when(n.between(128, 159), F.substr(F.lit(C1), (n - 127).cast("int"), F.lit(1)))
            .when(missing, "").otherwise(plain))


def _number(digits: Column, base: int) -> Column:
    """A number of any length; what is beyond all characters counts as one beyond them."""
    short = F.ltrim(digits, F.lit("0"))
    return F.when(F.length(short) > 7, 0x110000).when(short == "", 0).otherwise(F.conv(short, base, 10).cast("bigint"))


def unescape(text: Column) -> Column:
    """The text with its character references resolved, as `html.unescape` does."""
    from .text import let

    def resolved(part):
        def of(name):
            rest = F.substr(part, F.length(name) + 1, F.length(part))
            decimal, hexa = F.regexp_extract(name, "^#([0-9]+)", 1), F.regexp_extract(name, "^#[xX]([0-9a-fA-F]+)", 1)
            number = F.when(hexa != "", _number(hexa, 16)).otherwise(_number(decimal, 10))
            found = lambda key: F.try_element_at(F.get(_table(), (F.crc32(key) % _BUCKETS).cast("int")), key)
            begun = let(F.regexp_extract(name, BARE_NAME, 1), lambda bare: F.when(bare != "", F.concat(
                found(bare), F.substr(name, F.length(bare) + 1, F.length(name)))))
            named = F.coalesce(found(name), begun, F.concat(F.lit("&"), name))
            return F.concat(F.when(name == "", "&").when(name.startswith("#"), let(number, _char)).otherwise(named), rest)
        return let(F.regexp_extract(part, REFERENCE, 1), of)

    def joined(parts):
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), resolved), ""))
    return F.when(F.contains(text, F.lit("&")), let(F.split(text, "&", -1), joined)).otherwise(text)
