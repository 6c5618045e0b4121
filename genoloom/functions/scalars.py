"""Column expressions: identifiers, annotation cells, one-hot structs and numeric guards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT_ID = r"(.+):([0-9]+):([0-9]+):(.+?)>(.+)"
#: Ids without further marks. Repeats are possessive: no id makes them backtrack.
PLAIN_ID = r"^[^:\s]++:[0-9]++:[0-9]++:[^:>\s]++>[^:\s]++$"


def capture(c: Column, pattern: str, group: int) -> Column:
    """A capture group, null where the pattern doesn't match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def parse_variant_id(c: Column) -> dict[str, Column]:
    """``chrom:start:end:ref>alt`` in parts; ``-`` stands for an empty allele. Plain ids are cut at their marks; only those
    with further marks (contigs or breakends that hold ``:``) and ids that don't parse meet the capturing pattern."""
    plain = c.rlike(PLAIN_ID)
    last = F.substring_index(c, ":", -1)
    ref = F.substring_index(last, ">", 1)
    inner = lambda n: F.substring_index(F.substring_index(c, ":", n), ":", -1)
    cut = {"chrom": F.substring_index(c, ":", 1), "start": inner(2), "end": inner(3), "ref": ref, "alt": F.substr(last, F.length(ref) + 2)}
    parts = {name: F.when(plain, value).otherwise(capture(c, VARIANT_ID, i + 1)) for i, (name, value) in enumerate(cut.items())}
    parts["start"], parts["end"] = parts["start"].cast("bigint"), parts["end"].cast("bigint")
    for allele in ("ref", "alt"):
        parts[allele] = F.when(parts[allele] == "-", "").otherwise(parts[allele])
    return parts


def format_variant_id(chrom: Column, start: Column, end: Column, ref: Column, alt: Column) -> Column:
    return F.format_string("%s:%d:%d:%s>%s", chrom, start, end, ref, alt)


def split_position_id(c: Column) -> dict[str, Column]:
    """``chrom:pos:ref>alt`` with a 1-based position as the common variant key; the last part may be symbolic."""
    parts = F.split(c, "[:>]", 4)
    pos, ref = F.get(parts, F.lit(1)).cast("bigint"), F.get(parts, F.lit(2))
    return {
        "chrom": F.get(parts, F.lit(0)),
        "start": pos - 1,
        "end": pos - 1 + F.length(ref),
        "ref": ref,
        "alt": F.get(parts, F.lit(3)),
        "pos": pos,
    }


def bracket_label(c: Column) -> Column:
    """``word`` of ``word(number)``."""
    return F.regexp_replace(c, r"\(.*", "")


def bracket_score(c: Column) -> Column:
    """``number`` of ``word(number)`` as float, null without brackets."""
    return capture(c, r".*\((.*)\)", 1).try_cast("float")


def without_version(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def one_hot(c: Column, labels: Iterable[str]) -> Column:
    """Struct of booleans: the scalar equals the label; null in, null out."""
    return F.struct(*[(c == label).alias(label) for label in labels])


def one_hot_list(c: Column, labels: Iterable[str]) -> Column:
    """Struct of booleans: the array holds the label."""
    return F.struct(*[F.array_contains(c, label).alias(label) for label in labels])


def list_of(c: Column, kind: str) -> Column:
    """Comma-separated cell as an array; elements that don't parse are null."""
    parts = F.split(c, ",")
    return parts if kind == "string" else F.transform(parts, lambda x: x.try_cast(kind))


def smallest(c: Column) -> Column:
    """First element in order with nulls first: a list with a null gives null."""
    return F.get(F.sort_array(c), F.lit(0))


def minus_log10(c: Column) -> Column:
    """-log10 with infinity at 0; null for negative numbers and NaN."""
    return F.when(c == 0, F.lit(float("inf"))).when((c > 0) & ~F.isnan(c), -F.log10(c))


def no_nan(c: Column) -> Column:
    """NaN as null, so that a maximum skips it."""
    return F.when(~F.isnan(c), c)


def is_usable(c: Column, kind: str) -> Column:
    """Not null and, for floating types, not NaN; never null itself."""
    return c.isNotNull() & ~F.isnan(c) if kind in ("float", "double") else c.isNotNull()


def variant_type(ref: Column, alt: Column) -> Column:
    """Type of a variant by its alleles: REF, SNP, MNP, INDEL, or OTHER for symbolic alleles and breakends; null in, null out."""
    bases = only_bases(ref) & only_bases(alt)
    same = F.length(ref) == F.length(alt)
    known = F.when(same & (F.upper(ref) == F.upper(alt)), "REF").when(same & (F.length(ref) == 1), "SNP").when(same, "MNP").otherwise("INDEL")
    return F.when((alt == ".") | (alt == ref), "REF").when(bases, known).when(ref.isNotNull() & alt.isNotNull(), "OTHER")


def only_bases(c: Column) -> Column:
    return c.rlike("^[ACGTacgt]+$")
