"""SQL fragments for the text rules, written for the comparison side."""
from html.entities import html5

from ..functions import constants as K
from ..functions.text import FOLD_FROM, FOLD_TO, NOT_WORD, VERB_PATTERN, WS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listing(values) -> str:
    return ", ".join(lit(v) for v in values)


def squish(x):
    return f"trim(regexp_replace(coalesce({x}, ''), {lit(WS + '+')}, ' ', 'g'), ' ')"


def words(x):
    return f"list_filter(string_split({squish(x)}, ' '), lambda w: w <> '')"


def fold(x):
    return (f"regexp_replace(translate(lower(coalesce({x}, '')), {lit(FOLD_FROM)}, {lit(FOLD_TO)}), "
            r"'\p{Mn}+', '', 'g')")


def tokens(x):
    return f"regexp_extract_all({fold(x)}, '[a-z0-9]+')"


def sentences(x, abbreviations=K.ABBREVIATIONS, ends=".!?…", strip_quotes=True):
    t = squish(x)
    if abbreviations:
        t = f"regexp_replace({t}, {lit('(?i)(^|' + NOT_WORD + ')(' + abbreviations + ')[.]')}, '\\1\\2' || chr(57344), 'g')"
    t = f"regexp_replace({t}, {lit('([' + ends + ']) ')}, '\\1' || chr(31), 'g')"
    tidy = "replace(p, chr(57344), '.')"
    tidy = f"trim({tidy}, {lit(' ' + chr(9) + '«»' + chr(34) + chr(39) + '“”')})" if strip_quotes else f"trim({tidy}, ' ')"
    return f"list_filter(list_transform(string_split({t}, chr(31)), lambda p: {tidy}), lambda p: p <> '')"


def stem(w):
    first = f"regexp_replace({w}, {lit('^(.{4,}?)(?:' + '|'.join(K.SUFFIXES) + ')$')}, '\\1')"
    return f"regexp_replace({first}, '^(.{{4,}})d$', '\\1')"


def content_set(x):
    return (f"list_distinct(list_transform(list_filter({tokens(x)}, lambda w: length(w) > 2 AND NOT "
            f"list_contains([{listing(K.STOP_WORDS)}], w)), lambda w: {stem('w')}))")


def search_tokens(x):
    return (f"list_distinct(list_filter(regexp_extract_all({fold(x)}, '[a-z0-9áéíóúñ]+'), lambda w: length(w) > 2 "
            f"AND NOT list_contains([{listing(K.SEARCH_STOP_WORDS)}], w)))")


def has_verb(x):
    return f"regexp_matches(lower(coalesce({x}, '')), {lit(VERB_PATTERN)})"


def close_sentence(x):
    return f"regexp_replace(rtrim({x}, ' ,;:'), '([^.!?…])\\z', '\\1.')"


def without_tags(x):
    t = f"regexp_replace(coalesce({x}, ''), '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    return f"regexp_replace({t}, '(?s)<[^>]+>', ' ', 'g')"


def clean_html(source, key, x):
    """Query for (key, clean): references become rows, names meet a table of all names, pieces are joined again."""
    names = ", ".join(f"({lit(n)}, {lit(c)})" for n, c in html5.items())
    c1 = ", ".join(f"({128 + i}, {lit(bytes([128 + i]).decode('cp1252', 'ignore'))})" for i in range(32)
                   if bytes([128 + i]).decode("cp1252", "ignore"))
    return f"""WITH names(name, chars) AS (VALUES {names}), c1(n, chars) AS (VALUES {c1}),
  p AS (SELECT {key}, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (SELECT {key}, string_split({without_tags(x)}, '&') AS parts FROM {source})),
  m AS (SELECT *, CASE WHEN i > 1 THEN regexp_extract(part, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{{1,32}};?)') ELSE '' END AS ref FROM p),
  k AS (SELECT *, substr(part, length(ref) + 1) AS rest, CASE WHEN regexp_matches(ref, '^#[xX]') THEN coalesce(TRY_CAST('0x' || regexp_extract(ref, '[0-9a-fA-F]+', 0) AS BIGINT), 9999999)
      WHEN starts_with(ref, '#') THEN coalesce(TRY_CAST(regexp_extract(ref, '[0-9]+') AS BIGINT), 9999999) END AS n FROM m),
  bare AS (SELECT ref, max(length(name)) AS len FROM (SELECT DISTINCT ref FROM k WHERE ref <> '' AND n IS NULL) JOIN names ON NOT name LIKE '%;' AND starts_with(ref, name) GROUP BY ref),
  r AS (SELECT {key}, i, rest, CASE WHEN i = 1 THEN '' WHEN k.ref = '' THEN '&' WHEN k.n IS NOT NULL THEN
      CASE WHEN k.n = 0 OR k.n BETWEEN 55296 AND 57343 OR k.n > 1114111 THEN chr(65533) WHEN c1.chars IS NOT NULL THEN c1.chars WHEN k.n BETWEEN 128 AND 159 THEN chr(k.n::INT)
        WHEN k.n BETWEEN 1 AND 8 OR k.n = 11 OR k.n BETWEEN 14 AND 31 OR k.n = 127 OR k.n BETWEEN 64976 AND 65007 OR k.n % 65536 >= 65534 THEN '' ELSE chr(k.n::INT) END
      WHEN e.chars IS NOT NULL THEN e.chars WHEN b.len IS NOT NULL THEN o.chars || substr(k.ref, b.len + 1) ELSE '&' || k.ref END AS said
    FROM k LEFT JOIN names e ON e.name = k.ref LEFT JOIN bare b ON b.ref = k.ref LEFT JOIN names o ON o.name = substr(k.ref, 1, b.len) LEFT JOIN c1 ON c1.n = k.n)
  SELECT {key}, {squish("string_agg(said || rest, '' ORDER BY i)")} AS clean FROM r GROUP BY {key}"""


def nearest_rung(seconds, maximum=K.FRAMES_MAX):
    """Minimum over the listed rungs: written as a search, unlike the closed form it checks."""
    rungs = ", ".join(str(f) for f in range(K.FRAMES_MIN, maximum + 1, K.LADDER_STEP))
    return (f"CAST(list_sort(list_transform([{rungs}], lambda f: "
            f"{{'d': abs(f / 24.0::DOUBLE - ({seconds})), 'f': f}}))[1].f AS INT)")


def chars_checksum(x):
    return x
