"""Line-first cleaning: rules per line, failing lines go, then documents that lost too much go.

Everything is a column expression over one row, so there is no exchange at all: a hot source or a group of copies
costs what its bytes cost. Hashes of words are combined in three steps into one 64-bit hash per eight-word window;
two different windows of one text are taken for equal only if their hashes collide.

Defined results: a null text counts as empty; an empty text has no words and fails the base rule; repeated rows give
repeated results; a null id is kept as it is; all other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import BLANKS, GAP, free_name, table_files, text_batches
from rollkeep.sources.staging import staged

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; percentages are whole numbers.

    ``symbol_pct``: a line fails with more symbols than this share of its characters. ``nav_chars``: a line of at most
    so many characters fails if separators stand between three entries or more. ``boilerplate``: a line with one of
    these phrases fails if it has at most ``boilerplate_chars`` characters. ``lost_pct``: a document fails if the lines removed held more
    than this share of its word characters.
    """

    symbol_pct: int = 20
    nav_chars: int = 120
    boilerplate: tuple[str, ...] = (
        # English
        "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
        "enable javascript", "click here", "sign up for", "subscribe to our", "skip to content", "lorem ipsum",
        # German
        "cookie-richtlinie", "datenschutzerklärung", "nutzungsbedingungen", "alle rechte vorbehalten", "javascript aktivieren",
        "hier klicken", "klicken sie hier", "newsletter abonnieren", "jetzt anmelden", "zum inhalt springen",
        # French
        "politique de cookies", "politique de confidentialité", "conditions d'utilisation", "mentions légales",
        "tous droits réservés", "activer javascript", "cliquez ici", "inscrivez-vous à", "abonnez-vous à", "aller au contenu",
        # Spanish
        "política de cookies", "política de privacidad", "términos de uso", "condiciones de uso",
        "todos los derechos reservados", "habilitar javascript", "haga clic aquí", "haz clic aquí", "suscríbete a",
        "regístrate en", "saltar al contenido", "ir al contenido",
    )
    boilerplate_chars: int = 240
    lost_pct: int = 50
    least_words: int = 20
    repeat_pct: int = 30


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def _pairs(hashes: Column, n: Column, gap: int) -> Column:
    """Hashes of neighbours ``gap`` apart; one entry fewer per step of the gap."""
    left = F.slice(hashes, F.lit(1), F.greatest(n - gap, F.lit(0)))
    right = F.slice(hashes, F.lit(1 + gap), F.greatest(n - gap, F.lit(0)))
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def line_fails(line: Column, any_symbol: Column, rules: LineRules) -> Column:
    """Punctuation, navigation and boilerplate rules on one line that holds a word; ``any_symbol``: the text has symbols."""
    size = F.length(line)
    punctuation = (any_symbol & (_symbols(line) * 100 > size * rules.symbol_pct)) | ~line.rlike(r"[\p{L}\p{N}]")
    navigation = (size <= rules.nav_chars) & line.rlike(r"\S\s+[|»›·>]\s+\S.*\s[|»›·>]\s+\S")
    phrases = "|".join(re.escape(phrase).replace(r"\ ", r"\s+") for phrase in rules.boilerplate)
    alone = r"(?<![\p{L}\p{N}])(" + phrases + r")(?![\p{L}\p{N}])"  # \b knows no accented letters
    boilerplate = (size <= rules.boilerplate_chars) & F.lower(line).rlike(alone)
    return punctuation | navigation | boilerplate


def with_line_rules(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", name: str = "line_rules") -> tuple[DataFrame, str]:
    """The table with one struct column more, and that column's name: base measures, ``clean_text`` and ``kept``."""
    own = {k: free_name(docs, f"__{k}") for k in ("text", "symbols", "words", "lines", "bad", "n", "h", "w2", "w4", "w8", "twins", "at")}
    name = free_name(docs, name)
    c = {k: F.col(v) for k, v in own.items()}
    df = docs.withColumn(own["text"], F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn(own["symbols"], _symbols(c["text"]))
    df = df.withColumn(own["words"], F.when(_trimmed(c["text"]) == "", F.array().cast("array<string>")).otherwise(F.split(_trimmed(c["text"]), GAP)))
    df = df.withColumn(own["h"], F.transform(c["words"], lambda w: F.xxhash64(w))).withColumn(own["n"], F.size(c["words"]))
    df = df.withColumn(own["w2"], _pairs(c["h"], c["n"], 1))
    df = df.withColumn(own["w4"], _pairs(c["w2"], c["n"] - 1, 2))
    df = df.withColumn(own["w8"], _pairs(c["w4"], c["n"] - 3, 4))
    # Only texts in which some window occurs twice are sorted.
    placed = F.transform(c["w8"], lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn(own["twins"], F.when(F.size(F.array_distinct(c["w8"])) < F.size(c["w8"]), F.array_sort(placed)))
    near = lambda x, k: F.coalesce(F.get(c["twins"], k)["h"] == x["h"], F.lit(False))
    repeated = F.filter(c["twins"], lambda x, k: near(x, k - 1) | near(x, k + 1))
    df = df.withColumn(own["at"], F.array_sort(F.transform(repeated, lambda x: x["i"])))
    covered = F.aggregate(
        c["at"],
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("total")),
        lambda acc, p: F.struct((p + WINDOW).alias("upto"), (acc["total"] + p + WINDOW - F.greatest(acc["upto"], p)).alias("total")),
        lambda acc: acc["total"],
    )
    df = df.withColumn(own["lines"], F.filter(F.split(c["text"], "\n"), lambda line: _trimmed(line) != ""))
    df = df.withColumn(own["bad"], F.filter(c["lines"], lambda line: line_fails(line, c["symbols"] > 0, rules)))
    n_words, repeats = F.size(c["words"]).cast("long"), F.coalesce(covered, F.lit(0)).cast("long")
    chars = F.length(F.array_join(c["words"], "")).cast("long")
    lost = F.length(F.regexp_replace(F.array_join(c["bad"], ""), GAP, "")).cast("long")
    failed = (n_words < rules.least_words) | (repeats * 100 > n_words * rules.repeat_pct)
    good = F.filter(F.split(c["text"], "\n"), lambda line: (_trimmed(line) == "") | ~line_fails(line, c["symbols"] > 0, rules))
    result = F.struct(
        n_words.alias("n_words"),
        chars.alias("word_chars"),
        c["symbols"].alias("n_symbols"),
        (_size(c["lines"]) - _size(F.array_distinct(c["lines"]))).alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        failed.alias("base_failed"),
        _size(c["bad"]).alias("n_failed_lines"),
        lost.alias("lost_chars"),
        F.when(F.size(c["bad"]) == 0, c["text"]).otherwise(F.array_join(good, "\n")).alias("clean_text"),
        (~failed & (lost * 100 <= chars * rules.lost_pct)).alias("kept"),
    )
    return df.select(*[F.col(f"`{x}`") for x in docs.columns], result.alias(name)), name


def cleaned(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The documents that are kept, with their clean texts.

    The rules' result is staged before the filter: pushed below the steps that build it, the filter would repeat each of
    them for every use of the one before.
    """
    text_batches(docs.sparkSession)
    checked, name = with_line_rules(docs, rules, text)
    verdict = free_name(docs, "kept")
    columns = [F.col(f"{name}.clean_text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return staged(checked.select(*columns, F.col(f"{name}.kept").alias(verdict)), "checked", table_files(docs)).where(verdict).drop(verdict)
