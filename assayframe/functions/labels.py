"""Variant labels as column expressions.

A label is one codon change (``A12V``, ``A12A``, ``A12fs``, ``A12-``, ``A12*``,
``A12X``), several joined by ``|``, or ``WT``; a tag may follow a colon.  A null
label gives null everywhere.

``codons`` cuts a label to structs once; classes, positions and keys are read
from these.  Ranges of positions are arrays of structs that are searched.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Three-letter and one-letter names of amino acids.
AMINO_ACIDS = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Ter": "*",
    "Sec": "U",
}
#: Stars of a review status.
REVIEW_STARS = {
    "practice guideline": 4,
    "reviewed by expert panel": 3,
    "criteria provided, multiple submitters, no conflicts": 2,
    "criteria provided, single submitter": 1,
    "criteria provided, conflicting classifications": 1,
    "criteria provided, conflicting interpretations": 1,
    "no assertion criteria provided": 0,
    "no classification provided": 0,
    "no assertion provided": 0,
    "no classification for the individual variant": 0,
}


def _c(label: Column | str) -> Column:
    return F.col(label) if isinstance(label, str) else label


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def base_label(label: Column | str) -> Column:
    """The label without its tag."""
    return F.substring_index(_c(label), ":", 1)


def label_tag(label: Column | str) -> Column:
    """What follows the first colon, or null."""
    return F.try_element_at(F.split(_c(label), ":", 2), F.lit(2))


#: A codon change: what stands there, its place, what comes there.
CODON = r"^(.)(\d+)(.*)$"


def codons(label: Column | str) -> Column:
    """The changes of a label without its tag: array<struct<raw, reference, digits, change>>, empty strings where a part is missing."""

    def cut(raw: Column) -> Column:
        return F.struct(raw.alias("raw"), *(F.regexp_extract(raw, CODON, i).alias(n) for i, n in enumerate(("reference", "digits", "change"), 1)))

    return F.transform(F.split(base_label(label), r"\|"), cut)


def _place(codon: Column) -> Column:
    return codon["digits"].try_cast("bigint")


def _any(mark: str) -> Callable[[Column], Column]:
    return lambda all_: F.exists(all_, lambda c: c["raw"].rlike(mark))


def _deleted(all_: Column) -> Column:
    return F.element_at(all_, -1)["raw"].endswith("-")


def _one_run(all_: Column) -> Column:
    """One codon, or two next to each other."""
    first, second = F.get(all_, F.lit(0)), F.get(all_, F.lit(1))
    single = lambda c: F.length(c["change"]) == 1
    beside = single(first) & single(second) & (_place(first) + 1 == _place(second))
    return (F.size(all_) == 1) | ((F.size(all_) == 2) & F.coalesce(beside, F.lit(False)))


def _starts_as_substitution(all_: Column) -> Column:
    first = F.get(all_, F.lit(0))
    return first["reference"].between("A", "Z") & F.substring(first["change"], 1, 1).between("A", "Z")


def _same(all_: Column) -> Column:
    first = F.get(all_, F.lit(0))
    return _starts_as_substitution(all_) & first["change"].startswith(first["reference"])


#: Classes by what their codons show; the first that holds decides, and ``Other`` is left.
CLASSES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("Frameshift", _any("fs")),
    ("3nt Deletion", lambda all_: _deleted(all_) & _one_run(all_)),
    ("Other", _deleted),
    ("Nonsense", _any("[X*]")),
    ("WT", _any("WT")),
    ("Synonymous", _same),
    ("Single Missense", _starts_as_substitution),
)


def variant_type(label: Column | str) -> Column:
    """Class of a label."""
    named = _let(codons(label), lambda all_: F.coalesce(*(F.when(holds(all_), name) for name, holds in CLASSES), F.lit("Other")))
    return F.when(_c(label).isNotNull(), named)


#: A synonymous label without a tag: the same letter before and after the first place, and nothing of a class that goes before.
CONTROL = r"^(?!.*(?:fs|[X*:]|WT|-$))([A-Z])\d+\1"


def is_control(label: Column | str) -> Column:
    """Synonymous without a tag; a null label is no control."""
    return F.coalesce(_c(label).rlike(CONTROL), F.lit(False))


def relabel_wildtype(label: Column | str, wildtype: str) -> Column:
    return F.when(_c(label) == wildtype, "WT").otherwise(_c(label))


def _lone(label: Column | str, letters: str, make: Callable[[Column], Column]) -> Column:
    """``make(codon)`` for an untagged label of one codon that changes to a single one of ``letters``, else null."""

    def one(all_: Column) -> Column:
        codon = F.get(all_, F.lit(0))
        fits = (F.size(all_) == 1) & codon["reference"].rlike(f"^{letters}$") & codon["change"].rlike(f"^{letters}$")
        return F.when(fits & ~_c(label).contains(":"), make(codon))

    return _let(codons(label), one)


def position(label: Column | str, strict: bool = False) -> Column:
    """Position of the first codon; strict: of single substitutions only."""
    if strict:
        return _lone(label, "[A-Za-z]", _place)
    return _place(F.get(codons(label), F.lit(0)))


def substitution(label: Column | str) -> tuple[Column, Column, Column]:
    """Wild type, position and mutant of a single substitution, else nulls."""
    return tuple(_lone(label, "[A-Z]", make) for make in (lambda c: c["reference"], _place, lambda c: c["change"]))


def substitution_key(label: Column | str) -> Column:
    """Canonical key ``A12V``, a stop as ``*``; null for tagged and multiple changes."""

    def one(all_: Column) -> Column:
        codon = F.get(all_, F.lit(0))
        fits = (F.size(all_) == 1) & codon["reference"].rlike("^[A-Z]$") & codon["change"].rlike("^[A-Z*]$")
        return F.when(fits & ~_c(label).contains(":"), F.concat(codon["reference"], codon["digits"], F.translate(codon["change"], "X", "*")))

    return _let(codons(label), one)


def hgvs_key(text: Column | str) -> Column:
    """Canonical key of ``[accession:]p.(Arg123Trp)``; ``=`` repeats the reference."""
    names = F.create_map(*(F.lit(x) for pair in AMINO_ACIDS.items() for x in pair))
    pattern = r"^(?:.*:)?p\.\(?([A-Z][a-z]{2})(\d+)([A-Z][a-z]{2}|=|\*)\)?$"
    first, place, last = (F.nullif(F.regexp_extract(_c(text), pattern, i), F.lit("")) for i in (1, 2, 3))
    one = F.try_element_at(names, first)
    other = F.when(last == "=", one).when(last == "*", "*").otherwise(F.try_element_at(names, last))
    return F.concat(one, place, other)


def clinical_class(text: Column | str) -> Column:
    """Pathogenic or benign if each of the calls between slashes is, likely or not; else null."""
    calls = F.transform(F.split(F.lower(F.trim(_c(text))), "/"), lambda c: F.regexp_replace(c, "^likely ", ""))
    return F.when(F.forall(calls, lambda c: c == "pathogenic"), "P/LP").when(F.forall(calls, lambda c: c == "benign"), "B/LB")


def review_stars(status: Column | str, stars: Column | None = None) -> Column:
    """Stars given as a number, else those of the status, else zero."""
    known = F.create_map(*(x for k, v in REVIEW_STARS.items() for x in (F.lit(k), F.lit(v))))
    own = F.try_element_at(known, F.lower(F.trim(_c(status))))
    return F.coalesce(*([stars.try_cast("int")] if stars is not None else []), own, F.lit(0))


def blank_to_null(text: Column | str) -> Column:
    return F.when(F.trim(_c(text)) != "", _c(text))


def _holding(place: Column, ranges: Sequence[tuple[str, int, int]]) -> Column:
    """Names of the ranges that hold ``place``, in their order."""
    known = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(first).alias("first"), F.lit(last).alias("last")) for name, first, last in ranges))
    return F.transform(F.filter(known, lambda r: place.between(r["first"], r["last"])), lambda r: r["name"])


def region(place: Column, regions: Mapping[str, tuple[int, int]]) -> Column:
    """The first listed region whose inclusive range holds ``place``."""
    return F.get(_holding(place, [(name, *ends) for name, ends in regions.items()]), F.lit(0)) if regions else F.lit(None).cast("string")


def tiles(place: Column, ranges: Sequence[tuple[str, int, int]], several: bool = False) -> Column:
    """The first tile that holds ``place``, or all of them joined by commas; null outside."""
    if not ranges:
        return F.lit(None).cast("string")
    held = _holding(place, ranges)
    return F.nullif(F.array_join(held, ","), F.lit("")) if several else F.get(held, F.lit(0))


def posterior(ratio: Column, prior: float) -> Column:
    """Posterior probability from a likelihood ratio; 1 from an infinite one."""
    return F.when(ratio == float("inf"), 1.0).otherwise(F.try_divide(ratio * prior, (ratio - 1) * prior + 1))


def points(score: Column, ranges: Sequence[tuple[int, float, float]]) -> Column:
    """Points of the first inclusive range that holds the score, 0 outside or for NaN."""
    out = F.lit(0)
    for value, low, high in reversed(ranges):
        out = F.when(score.between(low, high) & ~F.isnan(score), value).otherwise(out)
    return out.cast("tinyint")


def on_grid(score: Column, low: float, step: float, values: Sequence[float]) -> Column:
    """Linear interpolation of ``values`` on a uniform grid, constant beyond its ends."""
    curve = F.array(*(F.lit(float(v)) for v in values))
    at = F.least(F.greatest((score - low) / step, F.lit(0.0)), F.lit(float(len(values) - 1)))
    left = F.floor(at).cast("int")
    right = F.least(left + 1, F.lit(len(values) - 1))
    return F.get(curve, left) + (at - left) * (F.get(curve, right) - F.get(curve, left))


def translate_codons(sequence: Column | str) -> Column:
    """Protein of a coding sequence; null if its length isn't a multiple of three or a letter is unknown."""
    bases = "TCAG"
    table = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"  # fixed values: standard code in TCAG order
    codes = F.create_map(*(F.lit(x) for i, amino in enumerate(table) for x in (bases[i // 16] + bases[i // 4 % 4] + bases[i % 4], amino)))
    text = F.upper(_c(sequence))
    letters = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / 3).cast("int") - 1), lambda i: F.try_element_at(codes, F.substring(text, i * 3 + 1, F.lit(3))))
    whole = (F.length(text) % 3 == 0) & (F.length(text) > 0)
    return F.when(whole, F.when(~F.exists(letters, lambda x: x.isNull()), F.array_join(letters, "")))
