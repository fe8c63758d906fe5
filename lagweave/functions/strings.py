"""Labels, identifiers and sequences as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_value(label: Column) -> Column:
    """The number in a time label; null where none is left."""
    digits = F.regexp_replace(label, "[^0-9.]", "")
    return F.when(digits.rlike(r"\d"), digits).cast("double")


def strip_id(gene: Column, pattern: str) -> Column:
    return F.regexp_replace(gene, pattern, "") if pattern else gene


def natural_key(label: Column) -> Column:
    """Sort key: the digits of a label as a number."""
    digits = F.regexp_replace(label, r"\D", "")
    return F.when(digits != "", digits).cast("long")


def gc_fraction(seq: Column) -> Column:
    return F.when(F.length(seq) > 0, F.length(F.regexp_replace(seq, "[^GCgc]", "")) / F.length(seq))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def kmers(seq: Column, k: int) -> Column:
    """Array of the distinct k-mers of a sequence, overlapping, forward strand."""
    every = F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substring(seq, i, F.lit(k)))
    return F.when(F.length(seq) >= k, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def key_values(text: Column) -> Column:
    """'a:x,b:y' as a map."""
    return F.str_to_map(text, F.lit(","), F.lit(":"))


def ranges(text: Column) -> Column:
    """'00-03,03-12' as an array of (low, high)."""
    return F.transform(F.split(text, ","), lambda r: F.struct(F.split(r, "-")[0].cast("double").alias("low"), F.split(r, "-")[1].cast("double").alias("high")))


def stage(value: Column, bounds: list[tuple[str, float, float]]) -> Column:
    """Name of the first range that holds a value, bounds included; else Unclassified."""
    return reduce(lambda tail, b: F.when((value >= b[1]) & (value <= b[2]), b[0]).otherwise(tail), reversed(bounds), F.lit("Unclassified"))


def contains_any(words: list[str], *columns: Column) -> Column:
    """Whether any of the columns holds any of the words, letter case aside."""
    return reduce(lambda a, b: a | b, [F.lower(F.coalesce(c, F.lit(""))).contains(w.lower()) for w in words for c in columns], F.lit(False))


def consensus(probabilities: Column) -> Column:
    """Letter of a column (A, C, G, T) whose probability is 0.5 or more, else N."""
    best = F.array_max(probabilities)
    return F.when(best >= 0.5, F.element_at(F.array(*map(F.lit, "ACGT")), F.array_position(probabilities, best).cast("int"))).otherwise("N")


def family_of(name: Column, families: list[str], alias: dict[str, str] | None = None) -> Column:
    """The family that a name stands for, letter case aside: its alias, else the same name, else the longest of the families and names that contain each other, the first of equal ones; null without one.

    families is a short list of a study's families."""
    low = F.lower(name)
    score = [
        F.struct(F.when(low == f.lower(), 1000).when(low.contains(f.lower()), len(f)).when(F.lit(f.lower()).contains(low) & (low != ""), F.length(name)).otherwise(0).alias("s"), F.lit(-k).alias("k"), F.lit(f).alias("f"))
        for k, f in enumerate(families)
    ]
    best = F.array_max(F.array(*score)) if score else F.lit(None)
    found = F.when(best["s"] > 0, best["f"]) if score else F.lit(None).cast("string")
    for k, v in (alias or {}).items():
        found = F.when(name == k, F.lit(v)).otherwise(found)
    return found


def kmer_ppm(kmer: Column) -> Column:
    """Columns of four shares (A, C, G, T) of a k-mer: 1 for its letter, a quarter each where it is none of the four."""
    letters = F.filter(F.split(F.upper(kmer), ""), lambda x: x != "")
    one = lambda x: F.array(*[F.when(x == c, 1.0).when(x.isin("A", "C", "G", "T"), 0.0).otherwise(0.25) for c in "ACGT"])
    return F.transform(letters, one)
