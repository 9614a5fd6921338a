"""Column functions over sequences, motifs and intervals; no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements, and the bases of each IUPAC code.
CODES, COMPLEMENTS = "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}
MISSING = ("", ".", "NA", "N/A", "NONE", "NULL", "NAN")


def reverse_complement(seq: Column) -> Column:
    """Upper-cased; null for symbols outside the IUPAC codes."""
    upper = F.upper(seq)
    return F.when(F.regexp_like(upper, F.lit(f"^[{CODES}]*$")), F.reverse(F.translate(upper, CODES, COMPLEMENTS)))


def rotations(motif: Column) -> Column:
    upper = F.upper(motif)
    size = F.length(upper)
    return F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.substring(upper, i, size), F.substring(upper, F.lit(1), i - 1)))


def primitive_motif(motif: Column) -> Column:
    """The shortest unit whose repetition is the motif; null when empty."""
    upper = F.upper(motif)
    size = F.length(upper)
    units = F.filter(
        F.when(size > 0, F.sequence(F.lit(1), size)),
        lambda p: (size % p == 0) & (F.call_function("repeat", F.substring(upper, F.lit(1), p), F.floor(size / p).cast("int")) == upper),
    )
    return F.substring(upper, F.lit(1), F.get(units, F.lit(0)))


def canonical_motif(motif: Column, primitive: bool = True) -> Column:
    """The least rotation of either strand, of the primitive unit unless told otherwise."""
    unit = primitive_motif(motif) if primitive else F.upper(motif)
    return F.array_min(F.concat(rotations(unit), rotations(reverse_complement(unit))))


def once(value: Column, f) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def motif_relation(a: Column, b: Column) -> Column:
    """Whether two motifs are one but for rotation and strand, as they are or by their primitive units.

    A text is a rotation of another of its length if the other, written twice, holds it; and it first comes again in
    itself written twice where its primitive unit ends.
    """
    a, b = (F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), f"[^{CODES}]", "") for c in (a, b))
    twice = lambda x: F.concat(x, x)
    unit = lambda x: F.left(x, F.call_function("locate", x, twice(x), F.lit(2)) - 1)

    def same(x: Column, y: Column) -> Column:
        return (F.length(x) == F.length(y)) & (F.contains(twice(x), y) | F.contains(twice(F.reverse(F.translate(x, CODES, COMPLEMENTS))), y))

    def relation(p: Column) -> Column:
        x, y = p["a"], p["b"]
        return (
            F.when((x == "") | (y == ""), "MOTIF_UNAVAILABLE")
            .when(same(x, y), "STRICT_DIHEDRAL_EQUIVALENT")
            .when(same(unit(x), unit(y)), "PRIMITIVE_DIHEDRAL_EQUIVALENT")
            .otherwise("MOTIF_MISMATCH")
        )

    return once(F.struct(a.alias("a"), b.alias("b")), relation)


def letters(text: Column) -> Column:
    """The characters of a text; none for an empty one."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def iupac_match(pattern: Column, concrete: Column) -> Column:
    """Whether a degenerate motif matches a concrete one in some rotation of either strand."""
    bases = F.create_map(*[F.lit(x) for item in IUPAC.items() for x in item])
    concrete = letters(F.upper(concrete))
    fits = lambda r: F.forall(F.zip_with(letters(r), concrete, lambda code, base: F.contains(F.coalesce(F.try_element_at(bases, code), code), base)), lambda x: x)
    ways = F.concat(rotations(pattern), rotations(reverse_complement(pattern)))
    return (F.length(pattern) > 0) & (F.length(pattern) == F.size(concrete)) & F.coalesce(F.exists(ways, fits), F.lit(False))


def split_motifs(text: Column) -> Column:
    """Motif tokens of a list text: brackets stripped, upper case, missing ones dropped, ordered and distinct."""
    parts = F.transform(F.split(F.trim(F.coalesce(text, F.lit(""))), r"[,;/|\s]+", -1), lambda t: F.upper(F.regexp_replace(t, r"^[\[\](){}'\"]+|[\[\](){}'\"]+$", "")))
    return F.array_distinct(F.filter(parts, lambda t: ~t.isin(*MISSING)))


def motif_of_locus_id(locus_id: Column) -> Column:
    """The last dash-separated token if it is made of IUPAC codes."""
    token = F.upper(F.element_at(F.split(locus_id, "-"), -1))
    return F.when(F.contains(locus_id, F.lit("-")) & F.regexp_like(token, F.lit(f"^[{CODES}]+$")), token)


def alphabet_class(motifs: Column) -> Column:
    joined = F.array_join(motifs, "")
    return (
        F.when(F.size(motifs) == 0, "NONE")
        .when(F.regexp_like(joined, F.lit("^[ACGT]*$")), "ACGT_ONLY")
        .when(F.regexp_like(joined, F.lit(f"^[{CODES}]*$")), "IUPAC_DEGENERATE")
        .otherwise("UNSUPPORTED_SYMBOL")
    )


def mean_quality(quality: Column) -> Column:
    """Mean Phred value of a quality string; null when empty."""
    total = F.aggregate(letters(quality), F.lit(0), lambda acc, c: acc + F.ascii(c) - 33)
    return F.when(F.length(quality) > 0, total / F.length(quality))


def complexity(seq: Column) -> Column:
    """Entropy, base fractions, dominant base, distinct 3-mers, longest homopolymer of a sequence.

    Ties go to the base that comes first in ACGTN; of equal homopolymers the first counts.
    """
    size = F.length(seq)
    count = {b: size - F.length(F.translate(seq, b, "")) for b in "ACGTN"}
    share = {b: c / size for b, c in count.items()}
    entropy = sum((F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in share.values()), F.lit(0.0))
    greatest = F.greatest(*count.values())
    dominant = F.coalesce(*[F.when(c == greatest, F.lit(b)) for b, c in count.items()])
    kmers = F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), size - 2), lambda i: F.substring(seq, i, F.lit(3)))))
    runs = F.regexp_extract_all(seq, F.lit(r"(.)\1*"), F.lit(0))
    # one pass over the runs, in which the first of equal ones is kept
    none = F.struct(F.lit(None).cast("int").alias("bp"), F.lit(None).cast("string").alias("run"))
    most = F.aggregate(runs, none, lambda a, r: F.when(a["bp"].isNull() | (F.length(r) > a["bp"]), F.struct(F.length(r).alias("bp"), r.alias("run"))).otherwise(a), lambda a: F.struct(a["bp"].alias("bp"), F.left(a["run"], F.lit(1)).alias("base")))
    return F.when(
        size > 0,
        F.struct(
            entropy.alias("entropy"),
            *[p.alias(f"fraction_{b.lower()}") for b, p in share.items()],
            dominant.alias("dominant_base"),
            F.when(size >= 3, kmers / F.least(F.lit(64), size - 2)).otherwise(0.0).alias("kmer_fraction"),
            most["bp"].alias("homopolymer_bp"),
            most["base"].alias("homopolymer_base"),
        ),
    )


def phase_purity(seq: Column, motif: Column) -> Column:
    """Best share of bases equal to a cyclic motif over all rotations of both strands; ties to the least rotation."""
    size = F.length(seq)
    ways = F.array_sort(F.array_distinct(F.concat(rotations(motif), rotations(reverse_complement(motif)))))
    bases = letters(seq)

    def scored(way: Column, i: Column) -> Column:
        laid = letters(F.substring(F.call_function("repeat", way, F.ceil(size / F.length(way)).cast("int")), F.lit(1), size))
        matches = F.aggregate(F.zip_with(bases, laid, lambda a, b: (a == b).cast("int")), F.lit(0), lambda x, y: x + y)
        return F.struct(matches.alias("matches"), (-i).alias("place"))

    best = F.array_max(F.transform(ways, scored))
    found = F.struct((best["matches"] / size).alias("purity"), F.get(ways, -best["place"]).alias("orientation"))
    return F.when((size > 0) & (F.length(motif) > 0), found)


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def distance(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Gap between two half-open intervals; 0 when they overlap or touch."""
    return F.greatest(F.lit(0), s2 - e1, s1 - e2)


def coordinates(text: Column) -> Column:
    """chrom, start, end candidates of `chr:start-end`: as 0-based and as 1-based coordinates."""
    pattern = r"^(?:chr)?([0-9A-Za-z_]+):([0-9,]+)-([0-9,]+)$"
    part = lambda i: F.regexp_extract(F.trim(text), pattern, i)
    start, end = (F.regexp_replace(part(i), ",", "").try_cast("long") for i in (2, 3))
    way = lambda shift, name: F.struct(F.concat(F.lit("chr"), part(1)).alias("chrom"), (start - shift).alias("start"), end.alias("end"), F.lit(name).alias("convention"))
    return F.filter(F.array(way(0, "ZERO_BASED"), way(1, "ONE_BASED")), lambda s: s["start"].isNotNull() & (s["start"] >= 0) & (s["end"] > s["start"]))


def stable_id(*parts: Column) -> Column:
    """The first 24 hex digits of the SHA-256 of parts joined by bars; nulls are dots."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(".")) for p in parts]), 256), 1, 24)


def strict_boolean(text: Column) -> Column:
    """true, 1, yes or false, 0, no; null for anything else."""
    norm = F.lower(F.trim(text))
    return F.when(norm.isin("true", "1", "yes"), True).when(norm.isin("false", "0", "no"), False)


def optional_int(text: Column) -> Column:
    """A struct of value and ok: empty and `.` are no value, negative or other text isn't ok."""
    norm = F.trim(text)
    value = norm.try_cast("long")
    return F.struct(F.when(value >= 0, value).alias("value"), F.coalesce(norm.isin("", ".") | (value >= 0), F.lit(False)).alias("ok"))


def motif_length_bin(n: Column) -> Column:
    return (
        F.when(n == 1, "1_homopolymer").when(n == 2, "2").when(n == 3, "3").when(n.between(4, 6), "4_to_6").when(n.between(7, 10), "7_to_10").otherwise("11_to_20")
    )


def span_length_bin(n: Column) -> Column:
    edges = (12, 20, 40, 80, 160, 320)
    label = F.when(n < edges[0], f"lt_{edges[0]}")
    for low, high in zip(edges, edges[1:], strict=False):
        label = label.when(n < high, f"{low}_to_{high - 1}")
    return label.otherwise(f"ge_{edges[-1]}")
