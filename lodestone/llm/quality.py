"""Line-first quality rules, in built-in column functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words (a Java regex class and the same characters plainly).
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Phrases of licence, consent and site furniture lines in English, German, French and Spanish, lower case.
BOILERPLATE = (
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "nutzungsbedingungen",
    "verwendet cookies",
    "tous droits réservés",
    "politique de confidentialité",
    "conditions d'utilisation",
    "utilise des cookies",
    "todos los derechos reservados",
    "política de privacidad",
    "condiciones de uso",
    "utiliza cookies",
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use cookies",
    "lorem ipsum",
    "enable javascript",
    "copyright ©",
    "copyright (c)",
)
#: Single words that are a menu entry when a line holds nothing else.
NAVIGATION = (
    "home", "menu", "login", "logout", "next", "previous", "search", "share", "sitemap", "contact", "about", "help",
    "startseite", "menü", "anmelden", "abmelden", "weiter", "zurück", "suche", "teilen", "kontakt", "hilfe",
    "accueil", "connexion", "suivant", "précédent", "rechercher", "partager", "aide",
    "inicio", "menú", "siguiente", "anterior", "buscar", "compartir", "contacto", "ayuda",
)
#: What closes a sentence, quotes and brackets behind it included.
CLOSING = tuple(".!?…:;,\"'”’»)]。！？")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row (a lambda variable holds it)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def count_chars(text: Column, chars: str) -> Column:
    # A class of characters in one scan; translate would look each character up in a map.
    return F.regexp_count(text, F.lit("[" + re.escape(chars) + "]")).cast("long")


def count_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


#: Up to so many distinct repeated windows are looked up one by one, more by sorting all windows with their places.
FEW = 16


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are compared by 64-bit hash. Only a text that holds a repeated
    window at all looks for the places of its repeated windows.
    """

    def covered(places: Column) -> Column:
        # Of rising places each covers three words, or fewer where the next one begins.
        steps = F.transform(places, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda n, x: n + x)

    def by_lookup(windows: Column, twice: Column) -> Column:
        return F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())

    def by_sorting(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal_neighbours(ordered: Column) -> Column:
            same = lambda k, x: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(ordered, lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"]))

        return let(pairs, equal_neighbours)

    def places(windows: Column) -> Column:
        repeats = lambda s: F.array_distinct(F.filter(s, lambda h, k: F.coalesce(F.get(s, k + 1) == h, F.lit(False))))
        found = let(let(F.sort_array(windows), repeats), lambda twice: F.when(F.size(twice) <= FEW, by_lookup(windows, twice)).otherwise(by_sorting(windows)))
        return let(found, covered)

    def count(w: Column) -> Column:
        windows = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(places(h)))

    return let(words, count).cast("long")


def line_fails(line: Column, max_symbols: float = 0.1, open_words: int = 10) -> Column:
    """Whether a line fails a rule.

    Boilerplate: it holds one of the phrases. Navigation: it is one menu word,
    or a list of entries parted by bars (three bars or more and a bar for at
    most every fourth word). Punctuation: it has at least ``open_words`` words and
    does not end in a closing mark (headings and list entries are shorter),
    ``#*$%&|<>{}`` are over ``max_symbols`` of its characters, or at least a fifth of
    its words end in two exclamation or question marks. Words of a line are its
    spaces, those at its ends aside, and one.
    """
    bars = F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))
    symbols = count_chars(line, SYMBOLS + "{}")
    shouts = F.when(F.rlike(line, F.lit("[!?]{2}")), F.size(F.split(line, r"[!?]{2,}(?:[\x20\x09-\x0D]|\z)")) - 1).otherwise(0)

    def furniture(low: Column) -> Column:
        found = low.isin(*NAVIGATION)
        for text in BOILERPLATE:
            found = found | F.contains(low, F.lit(text))
        return found

    def marks(m: Column) -> Column:
        return ((m["bars"] >= 3) & (m["bars"] * 4 >= m["words"])) | ((m["shouts"] > 0) & (m["shouts"] * 5 >= m["words"])) | ((m["words"] >= open_words) & ~m["last"].isin(*CLOSING))

    def judged(bare: Column) -> Column:
        measured = F.struct((count_spaces(bare) + 1).alias("words"), bars.alias("bars"), shouts.alias("shouts"), F.substring(bare, -1, 1).alias("last"))
        return let(measured, marks) | let(F.lower(bare), furniture)

    return (symbols > F.length(line) * max_symbols) | let(F.trim(line, F.lit(SPACE_CHARS)), judged)


def clean_and_judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = 0.3, passthrough: bool = False) -> DataFrame:
    """Clean every document line by line, then judge what is left.

    Each ``\\n`` line with a word is held against the line rules
    (:func:`line_fails`); failing lines go, blank lines stay. A document is rejected if it fails
    the base rules (fewer than 50 words, or more than half of its words in
    repeated 3-word windows), if more than ``max_lost`` of its word characters
    stood in failing lines, or if more than half of its lines repeat an earlier one.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines, n_failed_lines, lost_chars,
    clean_text``; with ``passthrough`` all columns of ``docs`` instead, and
    ``clean_text, base_failed, kept`` (these replace columns of such names).
    Every row is judged by itself, so repeated rows get equal answers. A null
    text counts as empty: no words, rejected; its ``clean_text`` is null. One
    pass, no shuffle; texts of any length are handled whole.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.struct(*([F.col(f"`{c}`") for c in docs.columns] if passthrough else [F.col(id_col).alias("doc_id")])).alias("row"), text.alias("text"), F.col(text_col).isNull().alias("none"))
    def summarise(lines: Column) -> Column:
        worded = F.filter(lines, has_word)
        return let(
            worded,
            lambda w: let(
                F.filter(w, lambda x: line_fails(x)),
                lambda bad: F.struct(
                    F.size(w).alias("n_lines"),
                    F.size(bad).alias("n_failed_lines"),
                    F.aggregate(bad, F.lit(0).cast("long"), lambda s, x: s + word_chars(x)).alias("lost_chars"),
                    (F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
                    F.when(F.size(bad) == 0, F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x: ~(has_word(x) & line_fails(x))), "\n")).alias("clean_text"),
                ),
            ),
        )

    summary = let(F.split("text", "\n"), summarise)
    counted = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    measured = base.select("row", "none", counted.alias("c"), summary.alias("l"), word_chars(F.col("text")).alias("word_chars"), count_chars(F.col("text"), SYMBOLS).alias("n_symbols"))
    base_failed = (F.col("c.n_words") < 50) | (F.col("c.n_repeat_words") * 100 > F.col("c.n_words") * 50)
    lost = F.col("l.lost_chars") > F.col("word_chars") * max_lost
    repeats = F.col("l.n_dup_lines") * 2 > F.col("l.n_lines")
    clean = F.when(~F.col("none"), F.col("l.clean_text"))
    kept = ~(base_failed | lost | repeats)
    if passthrough:
        own = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("clean_text", "base_failed", "kept")]
        return measured.select(*own, clean.alias("clean_text"), base_failed.alias("base_failed"), kept.alias("kept"))
    return measured.select(
        "row.doc_id", "c.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "c.n_repeat_words",
        base_failed.alias("base_failed"), kept.alias("kept"), "l.n_lines", "l.n_failed_lines", "l.lost_chars", clean.alias("clean_text"),
    )
