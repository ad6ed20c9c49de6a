"""Paths, file names and time as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    """The last folder's name; null if there is none."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.(mp3|wav)$", "")


def with_suffix(path: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(suffix))


def audio_path(base: str, channel: Column, year: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(base), channel, year, F.concat(stem(name), F.lit(".wav")))


def inner_path(path: Column, first: int) -> Column:
    """The parts from the `first` one (from 1) to the last but one, joined."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, F.lit(first), F.greatest(F.size(parts) - first, F.lit(0))), "/")


def normal_line(line: Column) -> Column:
    """Without leading slashes (two, then one more) and the newline at the end."""
    line = F.when(line.startswith("//"), line.substr(F.lit(3), F.length(line))).otherwise(line)
    line = F.when(line.startswith("/"), line.substr(F.lit(2), F.length(line))).otherwise(line)
    return F.regexp_replace(line, "\n$", "")


def id_tail(text: Column, size: int = 36) -> Column:
    return F.right(text, F.lit(size))


def link(base: str, ident: Column) -> Column:
    return F.concat(F.lit(base), ident)


def utterance_name(pair: Column, session: Column, row: Column) -> Column:
    return F.format_string("%s_%s_%d.wav", pair, session, row)


def hour_of(timestamp: Column) -> Column:
    return F.hour(F.to_timestamp(timestamp))


def night(hour: Column, wraparound: bool = False) -> Column:
    """Between 22 and 6 o'clock. Literally both at once, which no hour is; around midnight on request."""
    late, early = hour > 22, hour < 6
    return F.coalesce(late | early if wraparound else late & early, F.lit(False))


def half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)
