"""Column functions over text.  All native expressions: no Python in the hot path."""
from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from . import entities

# Whitespace as Unicode text defines it, spelled out so that every engine agrees.
WS = (r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
ODD_WS = WS.replace(r"\x{20}", r"\x{1F}")
IRREGULAR_WS = f" {WS}+|{ODD_WS}{WS}*"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
QUOTES = " \t«»\"'“”"


def _fold_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base letter plus marks."""
    src, dst = [], []
    for code in range(0xC0, 0x2000):
        ch = chr(code)
        if ch != ch.lower():
            continue
        parts = unicodedata.normalize("NFD", ch)
        base = [c for c in parts if unicodedata.category(c) != "Mn"]
        if len(parts) > 1 and len(base) == 1:
            src.append(ch)
            dst.append(base[0])
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def let(value: Column, body):
    """Bind an expression once.

    A lambda body evaluates whatever it captures again for every element, so anything that is
    not a plain column is bound before it is used inside one.
    """
    return F.transform(F.array(value), body)[0]


def once(df, **columns: Column):
    """Add columns that are computed once per row.

    A later filter on a plain projected column is pushed down by copying its expression, and a
    column that is used often is copied often.  A one-row generator stops that copying.
    """
    fields = [c.alias(n) for n, c in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


def squish(x) -> Column:
    """Collapse whitespace and trim.  Only runs and unusual blanks are rewritten."""
    return F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), IRREGULAR_WS, " "))


def strip_ws(x) -> Column:
    return F.btrim(_c(x), F.lit(WS_CHARS))


def words(x) -> Column:
    return F.filter(F.split(squish(x), " "), lambda w: w != "")


def word_count(x) -> Column:
    return F.size(words(x))


def squished_count(x) -> Column:
    """Number of words of a text whose words are separated by single blanks."""
    t = _c(x)
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1)


def fold_accents(x) -> Column:
    """Lower case without diacritics."""
    def fold(lowered):
        # a text of as many bytes as letters has no diacritics
        return F.when(F.octet_length(lowered) == F.length(lowered), lowered).otherwise(
            F.regexp_replace(F.translate(lowered, FOLD_FROM, FOLD_TO), r"\p{Mn}+", ""))
    return let(F.lower(F.coalesce(_c(x), F.lit(""))), fold)


def tokens(x) -> Column:
    return F.regexp_extract_all(fold_accents(x), F.lit("[a-z0-9]+"), F.lit(0))


def strip_html(x) -> Column:
    """Tags become blanks first and references are resolved after, so `&lt;b&gt;` stays text."""
    def without_tags(raw):
        t = F.regexp_replace(raw, r"(?is)<script[^>]*>.*?</script>", " ")
        t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", " ")
        return F.when(F.contains(raw, F.lit("<")), F.regexp_replace(t, r"(?s)<[^>]+>", " ")).otherwise(raw)
    return squish(let(let(F.coalesce(_c(x), F.lit("")), without_tags), entities.unescape))


def sentences(x, abbreviations: str | None = K.ABBREVIATIONS, ends: str = ".!?…",
              strip_quotes: bool = True, squished: bool = False) -> Column:
    """Split into sentences; a dot that belongs to an abbreviation does not end one.

    The split looks back from each blank, so the text is scanned once.  Words inside a
    sentence are separated by single blanks; squished says that those of the text are already.
    """
    boundary = f" (?<=[{ends}] )"
    if abbreviations:
        boundary += rf"(?<!(?:^|{NOT_WORD})(?iu:{abbreviations})\. )"
    edge = QUOTES if strip_quotes else " "
    return F.filter(F.transform(F.split(_c(x) if squished else squish(x), boundary), lambda p: F.btrim(p, F.lit(edge))),
                    lambda p: p != "")


_STEM = "^(.{4,}?)(?:" + "|".join(K.SUFFIXES) + ")$"


def stem(word) -> Column:
    cut = F.regexp_replace(_c(word), _STEM, "$1")
    return F.regexp_replace(cut, "^(.{4,})d$", "$1")


def content_set(x) -> Column:
    """Distinct stems of the informative words."""
    kept = F.filter(tokens(x), lambda w: (F.length(w) > 2) & ~w.isin(K.STOP_WORDS))
    return F.array_distinct(F.transform(kept, stem))


def search_tokens(x) -> Column:
    kept = F.filter(
        F.regexp_extract_all(fold_accents(x), F.lit("[a-z0-9áéíóúñ]+"), F.lit(0)),
        lambda w: (F.length(w) > 2) & ~w.isin(K.SEARCH_STOP_WORDS))
    return F.array_distinct(kept)


def verb_pattern(word: str = WORD, not_word: str = NOT_WORD) -> str:
    """One pattern for "some finite verb": a listed form, or a long enough word with a verb ending."""
    tails = "|".join(
        f"{word}{{{max(0, K.VERB_MIN_LENGTH - len(e))},}}{e}" for e in K.VERB_ENDINGS)
    listed = "|".join(sorted(set(K.VERB_FORMS)))
    return f"(^|{not_word})({listed}|{tails})({not_word}|$)"


VERB_PATTERN = verb_pattern()


def has_verb(x) -> Column:
    """Some finite verb: a listed form, or a long enough word with a verb ending."""
    listed = sorted(set(K.VERB_FORMS))

    def is_verb(w):
        ending = F.lit(False)
        for e in K.VERB_ENDINGS:
            ending = ending | w.endswith(e)
        return w.isin(listed) | ((F.length(w) >= K.VERB_MIN_LENGTH) & ending)

    lowered = F.lower(F.coalesce(_c(x), F.lit("")))
    return F.exists(F.regexp_extract_all(lowered, F.lit(WORD + "+"), F.lit(0)), is_verb)


def close_sentence(x) -> Column:
    return let(F.rtrim(_c(x), F.lit(" ,;:")), lambda t: F.when(
        (t == "") | F.right(t, F.lit(1)).isin(*".!?…"), t).otherwise(F.concat(t, F.lit("."))))


_MARKER = "^(" + "|".join(K.TAIL_MARKERS) + ") "
_MARKER_STARTS = sorted({m.split()[0] for m in K.TAIL_MARKERS})


def shorten(sentence, cap, minimum, squished: bool = False) -> Column:
    """Longest prefix of at most `cap` words that still reads as a sentence, or null.

    A cut is legal before a marker word, needs a verb in front of it and must not
    end in a word that asks for more.  A list is never cut at its conjunction.
    """
    cap, minimum = _c(cap), _c(minimum)

    def legal(n, ws, fd):
        last = F.btrim(F.element_at(fd, n), F.lit(".,;:()"))
        after = F.concat(F.array_join(F.slice(fd, n + 1, 3), " "), F.lit(" "))
        recent = F.slice(ws, F.greatest(n - 2, F.lit(1)), F.least(n, F.lit(3)))
        in_list = F.element_at(fd, n + 1).isin(list(K.LIST_MARKERS)) & (
            last.rlike("^[0-9.,%]+$") | F.exists(recent, lambda w: w.endswith(",")))
        return F.element_at(fd, n + 1).isin(_MARKER_STARTS) & after.rlike(_MARKER) & ~last.isin(K.FORBIDDEN_ENDINGS) & ~in_list

    def cut(ws):
        folded = F.split(fold_accents(F.array_join(F.slice(ws, 1, cap + 3), " ")), " ")
        cuts = let(folded, lambda fd: F.filter(F.sequence(minimum, cap), lambda n: legal(n, ws, fd)))

        def with_verb(ns):
            # the first verb decides: every later cut has it in front
            first = F.array_position(F.transform(F.slice(ws, 1, F.array_max(ns)), has_verb), True)
            return F.when(F.size(ns) > 0, let(first, lambda p: F.when(
                p > 0, F.array_max(F.filter(ns, lambda n: n >= p)))))

        best = let(cuts, with_verb)
        return let(best, lambda n: F.when(n.isNotNull(), close_sentence(F.array_join(F.slice(ws, 1, n), " "))))

    return let(_c(sentence) if squished else squish(sentence), lambda t: F.when(
        squished_count(t) <= cap, close_sentence(t)).otherwise(let(F.split(t, " "), cut)))


def repeated_prefix(unit_tokens, said: Column, minimum: int = K.LITERAL_REPEAT_TOKENS) -> Column:
    """Length of the longest opening run of tokens already said in a row, or 0.

    `said` is the blank-separated text of all tokens so far, with blanks at both ends.
    A prefix of a repeated run is itself repeated, so the shortest run is tested first.
    """
    def found(n):
        return F.contains(said, F.concat(F.lit(" "), F.array_join(F.slice(unit_tokens, 1, n), " "),
                                         F.lit(" ")))

    lengths = F.filter(F.sequence(F.lit(minimum), F.size(unit_tokens)), found)
    return F.when((F.size(unit_tokens) >= minimum) & found(F.lit(minimum)),
                  F.array_max(lengths)).otherwise(F.lit(0))


def prune_prefix(unit, n: Column) -> Column:
    """Drop the first `n` words and a leading connective; null when no sentence is left."""
    connectives = list(K.CONNECTIVES)

    def is_link(w):
        return F.regexp_replace(fold_accents(w), "^[,;:]+|[,;:]+$", "").isin(connectives)

    def is_blank(w):
        return F.regexp_replace(w, "[,;:]+", "") == ""

    def drop_while(ws, test):
        keep = F.filter(F.sequence(F.lit(1), F.size(ws)), lambda i: ~test(F.element_at(ws, i)))
        start = F.array_min(keep)
        return F.when(F.size(ws) == 0, ws).when(~test(ws[0]), ws).when(start.isNull(), F.slice(ws, 1, 0)).otherwise(
            F.slice(ws, start, F.size(ws)))

    def build(ws):
        rest = F.slice(ws, n + 1, F.greatest(F.size(ws) - n, F.lit(0)))
        return let(let(rest, lambda r: drop_while(r, is_link)), lambda r1:
                   let(drop_while(r1, is_blank), lambda r2:
                       let(F.regexp_replace(F.array_join(r2, " "), "^[,;: ]+", ""), lambda t:
                           F.when((F.size(r2) >= 5) & has_verb(t),
                                  close_sentence(F.concat(F.upper(F.substring(t, 1, 1)),
                                                          F.substring(t, 2, 2147483647)))))))

    return let(words(unit), lambda ws: F.when(n < F.size(ws), build(ws)))


def wrap_lines(x, width: int = K.CAPTION_WIDTH) -> Column:
    """Greedy wrapping that loses no word; a word longer than the width stays whole."""
    zero = F.expr("named_struct('done', cast(array() as array<string>), 'line', cast(null as string))")

    def step(acc, w):
        fits = F.length(acc["line"]) + 1 + F.length(w) <= width
        line = F.when(acc["line"].isNull(), w).when(fits, F.concat(acc["line"], F.lit(" "), w)).otherwise(w)
        done = F.when(acc["line"].isNotNull() & ~fits,
                      F.array_append(acc["done"], acc["line"])).otherwise(acc["done"])
        return F.struct(done.alias("done"), line.alias("line"))

    def finish(acc):
        return F.when(acc["line"].isNull(), acc["done"]).otherwise(
            F.array_append(acc["done"], acc["line"]))

    return F.aggregate(words(x), zero, step, finish)


def group_lines(lines: Column, size: int = K.CAPTION_LINES) -> Column:
    """Consecutive groups of at most `size` lines, each joined by a line break."""
    def build(ls):
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(ls) - 1, F.lit(0))),
                          lambda i: (i % size == 0) & (i < F.size(ls)))
        return F.transform(starts, lambda i: F.array_join(F.slice(ls, i + 1, size), "\n"))

    return let(lines, build)
