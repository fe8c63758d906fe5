"""Sequences: regions, k-mers, their enrichment, motifs and families."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.maths import hypergeometric_tail
from ..functions.strings import gc_fraction, kmers
from ..storage import stored
from .network import components
from .relational import value_rank


def regions(genes: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """gene, region, start, end (1-based, inclusive) of regions given as offsets from the start of transcription, strand aware.

    genes: gene, length (of its sequence), start, end, strand. Regions are clipped to the sequence; less than half of the expected width drops out."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("region"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (a, b) in bounds.items()])).alias("x")
    g = genes.select("gene", "length", "start", "end", "strand", each)
    plus = F.col("strand") == "+"
    low = F.when(plus, F.col("start") + F.col("x.a")).otherwise(F.col("end") - F.col("x.b"))
    high = F.when(plus, F.col("start") + F.col("x.b")).otherwise(F.col("end") - F.col("x.a"))
    g = g.withColumns({"from": F.greatest(F.lit(1), low), "to": F.least(F.col("length"), high)})
    return g.filter(F.col("to") - F.col("from") + 1 >= 0.5 * (F.col("x.b") - F.col("x.a") + 1)).select("gene", F.col("x.region").alias("region"), F.col("from").alias("start"), F.col("to").alias("end"))


def presence(sequences: DataFrame, k: int, alphabet: str = "ACGT") -> DataFrame:
    """gene, kmer: which k-mers of the alphabet a sequence holds; a sparse matrix of presence."""
    return sequences.select("gene", F.explode(kmers(F.upper("seq"), k)).alias("kmer")).filter(F.col("kmer").rlike(f"^[{alphabet}]+$"))


def with_gc(sequences: DataFrame) -> DataFrame:
    return sequences.withColumn("gc", gc_fraction(F.col("seq")))


def enrichment(present: DataFrame, labels: DataFrame, least: int = 5, ranked: bool = True) -> DataFrame:
    """kmer, pos, neg, pos_ratio, neg_ratio, fold, p and, if ranked, rank: one-sided exact test of each k-mer among positives (gene, positive).

    fold is the quotient of the rounded ratios: 10 where only positives have it, 1 where none has, at most 100."""
    total = labels.agg(F.sum(F.col("positive").cast("long")).alias("n_pos"), F.sum((~F.col("positive")).cast("long")).alias("n_neg"))
    n = present.join(labels, "gene").groupBy("kmer").agg(F.sum(F.col("positive").cast("long")).alias("pos"), F.sum((~F.col("positive")).cast("long")).alias("neg")).filter(F.col("pos") + F.col("neg") >= least).join(F.broadcast(total))
    n = n.withColumns({"pos_ratio": F.round(F.col("pos") / F.col("n_pos"), 4), "neg_ratio": F.round(F.col("neg") / F.col("n_neg"), 4)})
    fold = F.when(F.col("neg_ratio") > 0, F.least(F.lit(100.0), F.col("pos_ratio") / F.col("neg_ratio"))).when(F.col("pos_ratio") > 0, 10.0).otherwise(1.0)
    p = hypergeometric_tail(F.col("pos"), F.col("n_pos"), F.col("n_neg"), F.col("pos") + F.col("neg"))
    n = n.withColumns({"fold": F.round(fold, 6), "p": F.round(p, 9)})
    out = n.select("kmer", "pos", "neg", "pos_ratio", "neg_ratio", "fold", "p")
    return value_rank(stored(out, "enrichment"), "p", ["kmer"]) if ranked else out


def matched_negatives(genes: DataFrame, bins: int = 10, ratio: int = 3, seed: int = 42) -> DataFrame:
    """gene: negatives whose GC content is dealt over the deciles as that of the positives is; a short bin gives all that it has.

    genes: gene, positive, gc. Drawn by the order of a digest of seed and gene, so that every engine draws the same."""
    cuts = genes.agg(F.percentile("gc", F.array(*[F.lit(k / bins) for k in range(1, bins)])).alias("cuts"))
    g = genes.join(F.broadcast(cuts)).withColumn("bin", F.size(F.filter("cuts", lambda c: F.col("gc") > c)))
    need = g.filter("positive").groupBy("bin").agg((F.count("*") * ratio).alias("need"))
    order = F.row_number().over(W.partitionBy("bin").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("gene").cast("string")))))
    return g.filter(~F.col("positive")).join(F.broadcast(need), "bin").withColumn("k_", order).filter("k_ <= need").select("gene", "bin")


def near_kmers(words: DataFrame, most: int = 2) -> DataFrame:
    """a, b, distance: pairs of k-mers of a group (group, kmer) within an edit distance.

    Words within `most` edits share, of most + 1 pieces cut from either, one at a place shifted by at most `most`: the join is on pieces. A word of at
    most `most` letters may share none, and meets all words of twice that length by the empty piece."""
    pieces = most + 1
    w = words.select("group", "kmer").distinct().withColumn("n", F.length("kmer"))
    size = F.greatest(F.lit(1), F.floor(F.col("n") / pieces)).cast("int")
    cut = F.expr(f"transform(sequence(0, {pieces - 1}), i -> struct(i as i, substring(kmer, i * z + 1, case when i = {pieces - 1} then n else z end) as piece))")
    own = w.withColumn("z", size).withColumn("x", F.explode(cut)).select("group", "n", F.col("kmer").alias("a"), F.col("x.piece").alias("piece")).filter(f"piece <> '' OR n <= {most}").drop("n").distinct()
    sizes = own.select("group", F.length("piece").alias("m")).distinct()
    grams = w.join(sizes, "group").filter(f"m <= n AND (m > 0 OR n <= {2 * most})").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1))).select("group", F.col("kmer").alias("b"), F.substring("kmer", F.col("i"), F.col("m")).alias("piece")).distinct()
    pairs = own.join(grams, ["group", "piece"]).filter("a < b").select("group", "a", "b").distinct()
    return pairs.withColumn("distance", F.levenshtein("a", "b")).filter(F.col("distance") <= most)


def families(words: DataFrame, cut: float = 2.0) -> DataFrame:
    """group, kmer, family: complete-linkage clusters of the k-mers of a group (group, kmer) at an edit distance, numbered by their least k-mer.

    Clusters merge nearest first, ties by their least k-mers. All pairs of a cluster are within the cut, so clusters lie inside the
    connected components of near_kmers(), and the merges of one component do not bear on another's: a task holds the near pairs
    of one component, never all pairs of a group. Rows without group or k-mer take no part."""
    w = words.select("group", "kmer").filter("group IS NOT NULL AND kmer IS NOT NULL").distinct()
    pairs = stored(near_kmers(w, int(cut)), "near-kmers")
    # a node is a hash: equal ones of different k-mers would only lay two components into one task
    node = lambda c: F.xxhash64("group", c)
    parts = components(pairs.select(node("a").alias("a"), node("b").alias("b")))
    whole = pairs.join(parts, node("a") == F.col("node")).select("group", "component", "a", "b", "distance")
    linked = whole.groupBy("group", "component").applyInPandas(_linked, "group string, kmer string, head string")
    heads = w.join(linked, ["group", "kmer"], "left").select("group", "kmer", F.coalesce("head", "kmer").alias("head"))
    number = heads.select("group", "head").distinct().withColumn("family", F.row_number().over(W.partitionBy("group").orderBy("head")))
    return heads.join(number, ["group", "head"]).select("group", "kmer", "family")


def _linked(pairs: pd.DataFrame) -> pd.DataFrame:
    """group, kmer, head (least k-mer of its cluster) by complete linkage over all pairs within the cut (group, a, b, distance) of a component.

    near[x][y] is the largest distance between clusters x and y, which are named by their heads; pairs beyond the cut are not there."""
    near: dict[str, dict[str, int]] = {}
    for a, b, d in zip(pairs["a"], pairs["b"], pairs["distance"], strict=True):
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = int(d)
    members = {x: [x] for x in near}
    heap = [(d, x, y) for x, ys in near.items() for y, d in ys.items() if x < y]
    heapq.heapify(heap)
    while heap:
        d, x, y = heapq.heappop(heap)
        if near.get(x, {}).get(y) != d:
            continue  # merged, or farther since
        members[x] += members.pop(y)
        mine, other = near.pop(x), near.pop(y)
        near[x] = both = {z: max(mine[z], other[z]) for z in mine.keys() & other.keys()}
        for z in mine.keys() | other.keys():
            if z in (x, y):
                continue
            near[z].pop(y, None)
            if z not in both:
                near[z].pop(x, None)
            elif near[z].get(x) != both[z]:
                near[z][x] = both[z]
                heapq.heappush(heap, (both[z], min(x, z), max(x, z)))
    out = [(m, head) for head, ms in members.items() for m in ms]
    return pd.DataFrame({"group": [pairs["group"].iloc[0]] * len(out), "kmer": [m for m, _ in out], "head": [h for _, h in out]})


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def with_subsequence(regions_: DataFrame, sequences: DataFrame) -> DataFrame:
    """regions (gene, region, start, end) with the stretch of each gene's sequence (gene, seq), from the strand as it is stored."""
    return regions_.join(sequences.select("gene", "seq"), "gene").withColumn("part", F.substring("seq", F.col("start"), F.col("end") - F.col("start") + 1)).drop("seq")


def region_features(present: DataFrame, whitelist: DataFrame) -> DataFrame:
    """gene, feature (region_kmer): presence (gene, region, kmer) of the listed k-mers (region, kmer), for the genes that every region has."""
    n = present.select("region").distinct().agg(F.count("*").alias("n_"))
    common = present.groupBy("gene").agg(F.count_distinct("region").alias("k_")).join(F.broadcast(n)).filter("k_ = n_").select("gene")
    kept = present.join(common, "gene", "left_semi").join(whitelist.select("region", "kmer").distinct(), ["region", "kmer"], "left_semi")
    return kept.select("gene", F.concat_ws("_", "region", "kmer").alias("feature")).distinct()


def mean_gc(parts: DataFrame) -> DataFrame:
    """gene, gc: the mean over a gene's regions (gene, region, part) of their GC share; empty ones do not count."""
    return parts.groupBy("gene").agg(F.round(F.avg(gc_fraction(F.col("part"))), 6).alias("gc"))


def annotated(features: DataFrame, annotation: DataFrame, key: str) -> DataFrame:
    """features with what the annotation knows of their key; features without it stay, and a key that is annotated twice takes the first in order."""
    rest = [c for c in annotation.columns if c != key]
    first = annotation.groupBy(key).agg(F.min(F.struct(*rest)).alias("a_")).select(key, "a_.*")
    return features.join(first, key, "left")


def _aligned(base: np.ndarray, other: np.ndarray, overlap: int) -> tuple[float, int, np.ndarray]:
    """(mean column correlation, shift, strand used) of the best place of `other` against `base`; the first strand wins ties, then the leftmost shift."""
    best = (-2.0, 0, other)
    for strand in (other, other[::-1, ::-1]):
        for shift in range(-(len(strand) - overlap), len(base) - overlap + 1):
            a, b = max(0, shift), max(0, -shift)
            n = min(len(base) - a, len(strand) - b)
            if n >= overlap and (score := column_correlation(base[a : a + n], strand[b : b + n])) > best[0] + 1e-12:
                best = (score, shift, strand)
    return best


def merged_motif(kmers_: list[str], weights: list[float], overlap: int = 4, least_ic: float = 0.25) -> np.ndarray:
    """Columns of four shares of a family's k-mers: merged onto the heaviest at their best shift and strand, weighted, with thin edges cut.

    A place counts the weights of the k-mers that cover it; edge columns of less information than least_ic (bits) go, all but one column at most.
    A k-mer too short for the overlap is left out."""
    order = sorted(range(len(kmers_)), key=lambda k: (-weights[k], kmers_[k]))
    rows = [np.array([[1.0 if c == x else 0.0 for c in "ACGT"] if x in "ACGT" else [0.25] * 4 for x in kmers_[k].upper()]) for k in order]
    top = max(weights) or 1.0
    heavy = [max(10, round(weights[k] / top * 1000)) for k in order]
    total, weight = rows[0] * heavy[0], np.full(len(rows[0]), float(heavy[0]))
    for row, w in zip(rows[1:], heavy[1:], strict=True):
        least = min(overlap, len(row) - 1, len(total) - 1)
        if least < 1:
            continue
        _, shift, strand = _aligned(total / weight[:, None], row, least)
        left, right = max(0, -shift), max(0, shift + len(strand) - len(total))
        total, weight = np.pad(total, ((left, right), (0, 0))), np.pad(weight, (left, right))
        at = shift + left
        total[at : at + len(strand)] += strand * w
        weight[at : at + len(strand)] += w
    shares = total / weight[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = 2 + np.where(shares > 0, shares * np.log2(shares), 0.0).sum(1)
    good = np.flatnonzero(bits >= least_ic)
    return shares[good[0] : good[-1] + 1] if len(good) else shares[:1]


def consensus_motifs(members: DataFrame, overlap: int = 4, least_ic: float = 0.25) -> DataFrame:
    """name, ppm, consensus, width: the merged motif of each family (name, kmer, weight). A family is one row with its k-mers, a cluster's list."""
    each = members.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("kmer", "weight"))).alias("m"))

    def run(batches):
        for pdf in batches:
            ppm = [merged_motif([x["kmer"] for x in m], [float(x["weight"]) for x in m], overlap, least_ic) for m in pdf["m"]]
            letters = ["".join("ACGT"[c.argmax()] if c.max() >= 0.5 else "N" for c in p) for p in ppm]
            yield pd.DataFrame({"name": pdf["name"], "ppm": [np.round(p, 6).tolist() for p in ppm], "consensus": letters, "width": [len(p) for p in ppm]})

    return each.mapInPandas(run, f"name {dict(members.dtypes)['name']}, ppm array<array<double>>, consensus string, width int")


def aligned_to(pairs: DataFrame, overlap: int = 4) -> DataFrame:
    """name, motif, shift, pcc, ppm: each query's columns laid onto the database motif's (name, query, motif, base: arrays of columns), at the best shift and strand, padded by quarters and cut to its width."""

    def run(batches):
        for pdf in batches:
            out = []
            for name, motif, q, m in zip(pdf["name"], pdf["motif"], pdf["query"], pdf["base"], strict=True):
                q, m = (np.array([list(c) for c in x], float) for x in (q, m))
                least = min(overlap, len(q), len(m))
                score, shift, strand = _aligned(m, q, least)
                laid = np.full((len(m), 4), 0.25)
                a, b = max(0, shift), max(0, -shift)
                n = min(len(m) - a, len(strand) - b)
                laid[a : a + n] = strand[b : b + n]
                out.append((name, motif, shift, round(score, 6), np.round(laid, 6).tolist()))
            yield pd.DataFrame(out, columns=["name", "motif", "shift", "pcc", "ppm"])

    kinds = dict(pairs.dtypes)
    return pairs.select("name", "motif", "query", "base").mapInPandas(run, f"name {kinds['name']}, motif {kinds['motif']}, shift int, pcc double, ppm array<array<double>>")


def best_two(matches: DataFrame) -> DataFrame:
    """query, with its two best motifs side by side: top1, pcc1, top2, pcc2 (query, motif, pcc); null correlations count as -1 and come last."""
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc(F.coalesce("pcc", F.lit(-1.0))), "motif"))
    kept = matches.withColumn("k_", place).filter("k_ <= 2")
    at = lambda c, k: F.max(F.when(F.col("k_") == k, F.col(c)))
    return kept.groupBy("query").agg(at("motif", 1).alias("top1"), at("pcc", 1).alias("pcc1"), at("motif", 2).alias("top2"), at("pcc", 2).alias("pcc2"))


def position_weights(words: DataFrame) -> DataFrame:
    """group, place, A, C, G, T, letter: weighted letter shares of aligned words of one length (group, kmer, weight), with the majority letter or N."""
    from ..functions.strings import consensus

    each = words.select("group", "weight", F.posexplode(F.split("kmer", "")).alias("place", "letter")).filter("letter <> ''")
    share = [(F.sum(F.when(F.col("letter") == c, F.col("weight")).otherwise(0.0)) / F.sum("weight")).alias(c) for c in "ACGT"]
    return each.groupBy("group", "place").agg(*share).withColumn("letter", consensus(F.array(*"ACGT")))


def best_motifs(queries: DataFrame, motifs: DataFrame, top: int = 2, overlap: int = 4) -> DataFrame:
    """query, motif, pcc, rank: the motifs of most mean column correlation over all shifts and both strands.

    Both sides: name, ppm (array of columns of four shares). Motifs are a database of bounded size and go to every task."""
    base = [(r.name, np.array(r.ppm, float)) for r in motifs.select("name", "ppm").orderBy("name").collect()]

    def score(q: np.ndarray, m: np.ndarray) -> float:
        best = -1.0
        for other in (m, m[::-1, ::-1]):
            for shift in range(-len(q) + overlap, len(other) - overlap + 1):
                a, b = max(0, -shift), max(0, shift)
                n = min(len(q) - a, len(other) - b)
                if n >= overlap:
                    best = max(best, column_correlation(q[a : a + n], other[b : b + n]))
        return best

    def run(batches):
        for pdf in batches:
            out = []
            for name, ppm in zip(pdf["name"], pdf["ppm"], strict=True):
                got = sorted(((-score(np.array([list(c) for c in ppm], float), m), n) for n, m in base))[:top]
                out += [(name, n, round(-s, 6), k + 1) for k, (s, n) in enumerate(got)]
            yield pd.DataFrame(out, columns=["query", "motif", "pcc", "rank"])

    return queries.select("name", "ppm").mapInPandas(run, "query string, motif string, pcc double, rank int")


def column_correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over columns of the correlation of letter shares; a flat column counts as 0."""
    x, y = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
    scale = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    return float(np.divide((x * y).sum(1), scale, out=np.zeros(len(a)), where=scale > 0).mean())
