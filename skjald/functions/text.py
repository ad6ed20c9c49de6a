"""Transcript cleaning and checks as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and words that the cleaners delete, fold or spell out.
PUNCTUATION = ".,?:;!»«'\""
BASE_FOLDS = {"í": "i", "ó": "o"}
TALK_FOLDS = {"í": "i", "ó": "o", "à": "a", "ä": "æ", "ö": "æ"}
DASHES = "-—–"
TALK_SYMBOLS = "→↗&><)“”"
VOCABULARY = " abcdefghijklmnopqrstuvwxyzæøåéü"
UNITS = ["nul", "en", "to", "tre", "fire", "fem", "seks", "syv", "otte", "ni", "ti", "elleve", "tolv", "tretten", "fjorten", "femten", "seksten", "sytten", "atten", "nitten"]
TENS = ["", "", "tyve", "tredive", "fyrre", "halvtreds", "tres", "halvfjerds", "firs", "halvfems"]


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def fold(text: Column, folds: dict[str, str]) -> Column:
    return F.translate(text, "".join(folds), "".join(folds.values()))


def collapse(text: Column) -> Column:
    """Runs of blanks become one; blanks at the ends stay."""
    return F.regexp_replace(text, " +", " ")


def clean_basic(text: Column) -> Column:
    """Punctuation goes, accents fold, dashes become blanks; lower case comes last, as folds are for small letters only."""
    text = fold(without(text, PUNCTUATION), BASE_FOLDS)
    return F.lower(collapse(F.translate(text, DASHES, " " * len(DASHES))))


def without_brackets(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\([^)]*\)", ""), r"[(\[].*?[)\]]", "")


def number_words(n: int) -> str:
    """Danish words of a whole number below a billion."""
    if n < 20:
        return UNITS[n]
    if n < 100:
        return (UNITS[n % 10] + "og" if n % 10 else "") + TENS[n // 10]
    for size, one, many in ((1_000_000, "en million", "millioner"), (1000, "et tusind", "tusind"), (100, "et hundrede", "hundrede")):
        if n >= size:
            head = one if n // size == 1 else f"{number_words(n // size)} {many}"
            rest = n % size
            return head if not rest else f"{head} {'og ' if rest < 100 else ''}{number_words(rest)}"
    raise AssertionError


def _small_number(n: Column) -> Column:
    units, tens = F.array(*map(F.lit, UNITS)), F.array(*map(F.lit, TENS))
    unit = F.element_at(units, (n % 10 + 1).cast("int"))
    both = F.concat(F.when(n % 10 > 0, F.concat(unit, F.lit("og"))).otherwise(""), F.element_at(tens, (F.floor(n / 10) + 1).cast("int")))
    return F.when(n < 20, F.element_at(units, (F.least(n, F.lit(19)) + 1).cast("int"))).otherwise(both)


def _number(n: Column, sizes: tuple = ((1_000_000, "en million", "millioner"), (1000, "et tusind", "tusind"), (100, "et hundrede", "hundrede"))) -> Column:
    if not sizes:
        return _small_number(n)
    (size, one, many), rest = sizes[0], n % sizes[0][0]
    count = F.floor(n / size)
    head = F.when(count == 1, F.lit(one)).otherwise(F.concat_ws(" ", _number(count, sizes[1:] if size > 100 else ()), F.lit(many)))
    tail = F.when(rest > 0, F.concat(F.when(rest < 100, F.lit(" og ")).otherwise(" "), _number(rest, sizes[1:]))).otherwise("")
    return F.when(n < size, _number(n, sizes[1:])).otherwise(F.concat(head, tail))


def spell_numbers(text: Column) -> Column:
    """Each run of digits in Danish words; runs of more than nine digits are spelt digit by digit."""
    digits = F.regexp_extract_all(text, F.lit(r"([0-9]+)"), F.lit(1))
    pieces = F.split(text, r"[0-9]+", -1)
    single = F.array(*map(F.lit, UNITS[:10]))

    def spelt(run: Column) -> Column:
        each = F.array_join(F.transform(F.split(run, ""), lambda c: F.element_at(single, c.cast("int") + 1)), " ")
        return F.when(F.length(run) > 9, each).otherwise(_number(F.substring(run, 1, 9).cast("long")))

    words = F.concat(F.transform(digits, spelt), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(pieces, words, lambda a, b: F.concat(a, b)), "")
    return F.when(F.size(digits) > 0, joined).otherwise(text)


def clean_talk(text: Column, numbers: bool = True) -> Column:
    """Cleaner for conversational transcripts: unclear and bracketed speech goes, symbols and digits are spelt."""
    text = F.regexp_replace(text, "xx*", "")
    text = F.regexp_replace(without_brackets(text), "host", "")
    text = fold(without(text, PUNCTUATION + TALK_SYMBOLS), TALK_FOLDS)
    text = F.regexp_replace(text, "%", " procent")
    text = F.regexp_replace(F.translate(text, DASHES + "/", " " * (len(DASHES) + 1)), "\r?\n", " ")
    return F.lower(collapse(spell_numbers(text) if numbers else text))


def in_vocabulary(text: Column) -> Column:
    return text.rlike(f"^[{VOCABULARY}]*$") & ~F.contains(text, F.lit("\n"))


def first_outside(text: Column) -> Column:
    """The first character that the vocabulary lacks; empty if there is none."""
    return F.regexp_extract(text, f"[^{VOCABULARY}]", 0)


def has_number(text: Column) -> Column:
    return text.rlike(r"\p{Nd}")


def digit_runs(text: Column) -> Column:
    """Runs of decimal digits of any script."""
    return F.regexp_extract_all(text, F.lit(r"(\p{Nd}+)"), F.lit(1))


def letters(text: Column) -> Column:
    """A blank between all characters, and a bar for each blank of the text."""
    return F.array_join(F.split(F.translate(text, " ", "|"), ""), " ")


def seconds(text: Column) -> Column:
    """Numbers that end in S, as in 3.5S; null if that isn't one."""
    return F.rtrim(text, F.lit("S")).try_cast("double")


def whole_string(number: Column) -> Column:
    return number.cast("int").cast("string")
