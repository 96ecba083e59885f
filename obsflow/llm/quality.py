"""Line-first quality rules, in SQL expressions only.

Every line is judged on its own: it must close with punctuation, must not be a
row of menu entries, must not be a short line of known boilerplate (in four
languages), shouting or mark-up litter. Failing lines are removed; a document that loses more than half of its
characters that way is rejected, and so is one that fails the base rules (too
few words, too many repeated three-word windows).

One scan and one projection: nothing is shuffled, every row is judged from its
own text, so repeated rows, ties and hot sources need no care. Null text counts
as empty and fails. Only the key and the text are read; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Word separators, symbols and base limits.
GAPS = (r"\t", r"\n", r"\u000B", r"\u000C", r"\r")
HAS_WORD = r"[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEAT_PERCENT = 50

# The method's own rules.
MOST_LOST = 0.5
CLOSERS = r"\'\")]»”’ \t\r"
CLOSING = ".!?:;…。！？"
BARS, MOST_BARS = "|»›·•", 2
MOST_SHOUTS = 2
LITTER_SHARE = 0.05
# Site phrases in four languages, lower case. A line fails if it has at most so many characters for each phrase it holds:
# a notice does, a paragraph that speaks of a login does not.
CHARS_A_PHRASE = 120
BOILERPLATE = (
    "cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright",
    "licensed under", "released under", "subscribe", "newsletter", "sign in", "sign up", "log in", "login",
    "javascript", "click here", "read more", "share this", "lorem ipsum",
    "datenschutz", "impressum", "nutzungsbedingungen", "alle rechte vorbehalten", "jetzt anmelden", "jetzt registrieren",
    "abonnieren", "weiterlesen", "hier klicken", "seite teilen",
    "politique de confidentialité", "mentions légales", "conditions générales", "tous droits réservés", "abonnez-vous",
    "inscrivez-vous", "connectez-vous", "lire la suite", "cliquez ici", "partager cet article",
    "política de privacidad", "aviso legal", "términos de uso", "condiciones de uso", "todos los derechos reservados",
    "suscríbete", "regístrate", "iniciar sesión", "leer más", "haz clic aquí", "compartir este artículo",
)


def without(text: str, chars: tuple[str, ...] | str, put: str = "") -> str:
    """SQL: the text with each of the characters replaced; cheap where they are absent."""
    for c in chars:
        text = f"replace({text}, '{c}', '{put}')"
    return text


def any_of(text: str, phrases: tuple[str, ...] | str) -> str:
    """SQL condition: does the text hold one of the phrases?"""
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


# What a document must hold at all before its lines are tested for it.
GATES = {
    "has_boilerplate": any_of("low", BOILERPLATE),
    "has_bars": any_of("body", BARS),
    "has_shouts": "contains(body, '!!')",
    "has_symbols": any_of("body", SYMBOLS),
}


def _is_boilerplate(line: str) -> str:
    """SQL condition: are the phrases that the line holds most of what it says?"""
    phrases = ", ".join(f"'{p}'" for p in BOILERPLATE)
    return f"exists(array(lower({line})), l -> {CHARS_A_PHRASE} * size(filter(array({phrases}), p -> contains(l, p))) >= length({line}))"


def line_fails(line: str) -> str:
    """SQL condition: does the line break a rule?"""
    symbols = f"length({line}) - length({without(line, SYMBOLS)})"
    return (
        f"instr('{CLOSING}', right(rtrim('{CLOSERS}', {line}), 1)) = 0 OR right(rtrim('{CLOSERS}', {line}), 1) = ''"
        f" OR has_boilerplate AND {_is_boilerplate(line)}"
        f" OR has_bars AND length({line}) - length({without(line, BARS)}) > {MOST_BARS}"
        f" OR has_shouts AND length({line}) - length(replace({line}, '!!', '')) > {2 * MOST_SHOUTS}"
        f" OR has_symbols AND {symbols} > {LITTER_SHARE} * length({line})"
    )


def _repeated_words(windows: str) -> str:
    """Words inside three-word windows whose hash occurs twice or more.

    Without a repeat (a hash set tells) nothing is sorted. Otherwise the windows
    are sorted with their places, and neighbours compared.
    """
    pairs = f"sort_array(transform({windows}, (h, i) -> struct(h AS h, i AS i)))"
    neighbours = f"""transform(array({pairs}), s -> flatten(zip_with(
        slice(s, 1, size(s) - 1), slice(s, 2, size(s)),
        (a, b) -> CASE WHEN a.h = b.h THEN array(a.i, b.i) ELSE CAST(array() AS ARRAY<INT>) END)))[0]"""
    words = f"array_distinct(flatten(transform({neighbours}, i -> array(i, i + 1, i + 2))))"
    return f"CASE WHEN size(array_distinct({windows})) = size({windows}) THEN 0L ELSE CAST(size({words}) AS BIGINT) END"


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, base counts, ``base_failed``, cleaned text (``clean_text``), share lost and ``kept``."""
    body = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    body = body.selectExpr("key", "body", "lower(body) AS low")
    flat = body.selectExpr("key", "body", f"{without('body', GAPS, ' ')} AS flat", *[f"{test} AS {name}" for name, test in GATES.items()])
    parts = flat.selectExpr(
        "*",
        "filter(split(flat, ' '), x -> x <> '') AS words",
        f"filter(split(body, '\\n'), x -> rlike(x, '{HAS_WORD}')) AS lines",
    )
    windows = parts.selectExpr(
        "*",
        "CASE WHEN size(words) < 3 THEN CAST(array() AS ARRAY<BIGINT>) ELSE"
        " transform(sequence(1, size(words) - 2), i -> xxhash64(words[i - 1], words[i], words[i + 1])) END AS windows",
        f"filter(lines, x -> NOT ({line_fails('x')})) AS good_lines",
    )
    counted = windows.selectExpr(
        "key",
        "CAST(size(words) AS BIGINT) AS n_words",
        "CAST(length(replace(flat, ' ', '')) AS BIGINT) AS word_chars",
        f"CAST(length(body) - length({without('body', SYMBOLS)}) AS BIGINT) AS n_symbols",
        "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines",
        f"{_repeated_words('windows')} AS n_repeat_words",
        "array_join(good_lines, '\\n') AS clean_text",
        "aggregate(lines, 0L, (a, x) -> a + length(x)) AS line_chars",
        "aggregate(good_lines, 0L, (a, x) -> a + length(x)) AS good_chars",
    )
    judged = counted.selectExpr(
        "*",
        f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed",
        "CASE WHEN line_chars = 0 THEN 1D ELSE 1 - good_chars / line_chars END AS lost_share",
    )
    return judged.selectExpr(
        f"key AS `{key}`", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        f"NOT base_failed AND lost_share <= {MOST_LOST}D AS kept", "clean_text", "lost_share",
    )
