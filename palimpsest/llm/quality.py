"""Line-first quality rules, in DataFrame functions only.

Each line is judged by punctuation, navigation and boilerplate rules; failing lines go; documents
that lose too much of their text with them, or fail the document rules, are rejected. All work is
per row, so there is no shuffle and no state beyond one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, trimmed_words, word_count

ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "lost_share", "kept", "_words", "_lines", "_clean")
SYMBOLS = "#*$%&|<>"
ACCEPTED_END = r"[\p{L}\p{N}.!?:;,\"'’”)\]…]|^$"
#: Phrases that mark a line as boilerplate in English, German, French and Spanish, lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies",
    "uses cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter", "click here to", "sign up for",
    "powered by", "back to top", "skip to content",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "verwendet cookies", "cookies akzeptieren",
    "javascript aktivieren", "newsletter abonnieren", "klicken sie hier", "nach oben", "zum inhalt springen",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité", "utilise des cookies", "accepter les cookies",
    "activer javascript", "abonnez-vous à notre newsletter", "cliquez ici", "retour en haut", "aller au contenu",
    "todos los derechos reservados", "términos de uso", "política de privacidad", "utiliza cookies", "aceptar las cookies",
    "habilitar javascript", "suscríbete a nuestro boletín", "haga clic aquí", "volver arriba", "saltar al contenido",
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use`` (a lambda variable, never inlined again)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words inside windows of ``window`` words that are found twice or more in the array.

    Windows are compared by 64-bit hashes of their words. Sorting (hash, position) pairs puts equal
    windows side by side; the positions of windows with an equal neighbour, in order, each add
    the words that the one before did not cover.
    """

    def grams(w: Column) -> Column:
        n = F.size(w) - (window - 1)
        pair = lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(window)]).alias("h"), i.alias("i"))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), pair)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def repeats(pairs: Column) -> Column:
        hashes = lambda h: F.transform(pairs, lambda x, k: F.when((F.get(h, k - 1) == x["h"]) | (F.get(h, k + 1) == x["h"]), x["i"]))
        return F.sort_array(F.array_compact(let(pairs["h"], hashes)))

    def covered(at: Column) -> Column:
        step = lambda s, x: F.struct((s["n"] + F.least(x - s["last"], F.lit(window))).alias("n"), x.alias("last"))
        start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(at, start, step, lambda s: s["n"])

    return let(words, lambda w: let(F.sort_array(grams(w)), lambda p: let(repeats(p), covered)))


def ends_badly(line: Column, min_words: int = 3) -> Column:
    """Whether a line of ``min_words`` words or more ends in none of the accepted characters."""
    last = F.substring(F.rtrim(line), -1, 1)
    return ~last.rlike(ACCEPTED_END) & (word_count(line) >= min_words)


def line_verdict(line: Column) -> Column:
    """Name of the rule that a line fails, or null.

    boilerplate: has a phrase of ``BOILERPLATE``. navigation: over a third of its tokens are bare
    separators. symbols: over a quarter of its tokens end in a run of symbols. shouting: over half
    of its words end in two exclamation marks. punctuation: it has three words or more and ends in
    no letter, digit, sentence, clause or closing mark. A blank line fails nothing.
    """
    runs = lambda pattern: F.regexp_count(line, F.lit(pattern))
    return let(word_count(line), lambda n: F.when(n == 0, None)
        .when(F.greatest(*[F.lower(line).contains(p) for p in BOILERPLATE]), "boilerplate")
        .when(3 * runs(r"(?<![^\x20\x09-\x0D])[|>/»•]+(?![^\x20\x09-\x0D])") > n, "navigation")
        .when(4 * runs(r"[#*$%&<>|]+(?![^\x20\x09-\x0D])") > n, "symbols")
        .when(2 * runs(r"!!+(?![^\x20\x09-\x0D])") > n, "shouting")
        .when(ends_badly(line), "punctuation"))


def clean_lines(text: Column) -> Column:
    """The lines of ``text`` that fail no rule, joined again.

    All rules but the one on punctuation need a phrase or mark that most texts lack as a whole;
    those texts have their lines judged by punctuation alone.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.split(whole, "\n", -1)
    marks = [whole.contains(m) for m in (*SYMBOLS, "/", "»", "•", "!!")]
    suspect = let(F.lower(whole), lambda low: F.greatest(*marks, *[low.contains(p) for p in BOILERPLATE]))
    return F.array_join(
        F.when(suspect, F.filter(lines, lambda x: line_verdict(x).isNull())).otherwise(F.filter(lines, lambda x: ~ends_badly(x))), "\n"
    )


def assess(docs: DataFrame, text_col: str = "text", max_lost: float = 0.3, min_words: int = 50, max_repeat: float = 0.5,
           max_dup_lines: float = 0.3) -> DataFrame:
    """All rows of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, clean_text, lost_share and kept added.

    Null and empty texts have no words, fail the base rules and are not kept. A document is kept
    when it passes the base rules (``min_words``; at most ``max_repeat`` of the words in repeated
    windows of three), its lines that fail a rule hold at most ``max_lost`` of its word characters,
    and at most ``max_dup_lines`` of its lines with words repeat an earlier one (two always may).
    Repeated rows are judged alike. Input columns of the added names are replaced.
    """
    docs = docs.drop(*ADDED)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = lambda joined: F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, " ", -1))

    def in_words(joined: Column) -> Column:
        return let(words(joined), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            (F.length(joined) - F.greatest(F.size(w) - 1, F.lit(0))).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words")))

    symbols = sum(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in SYMBOLS)
    measured = (
        docs.withColumn("_words", let(trimmed_words(F.col(text_col)), in_words))
        .withColumn("_lines", let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))))
        .withColumn("n_symbols", symbols.cast("long"))
        .withColumn("_clean", let(clean_lines(F.col(text_col)), lambda c: F.struct(
            c.alias("text"), F.length(F.regexp_replace(c, SPACE_CLASS, "")).alias("chars"))))
        .select("*", "_words.*", F.col("_clean.text").alias("clean_text"))
    )
    lost = F.when(F.col("word_chars") > 0, 1 - F.col("_clean.chars") / F.col("word_chars")).otherwise(F.lit(1.0))
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return (
        measured.withColumn("n_dup_lines", (F.col("_lines.n") - F.col("_lines.distinct")).cast("long"))
        .withColumn("lost_share", lost)
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & (F.col("lost_share") <= max_lost)
                    & ((F.col("n_dup_lines") <= 2) | (F.col("n_dup_lines") <= max_dup_lines * F.col("_lines.n"))))
        .drop("_lines", "_words", "_clean")
    )
