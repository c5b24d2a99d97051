"""Quality by a hierarchical empirical Bayes classifier: document evidence, path and host posteriors.

A document's evidence is a naive Bayes log ratio over binned text measures, with bin frequencies counted over all labelled training rows.
Without labels of its own a site is judged by its documents: their classifier posteriors are summed by path and by host. Host means
are shrunk towards the global mean and path means towards their host's, with prior strengths estimated by the method of moments from the
variance between sites, so sparse sites keep close to the level above. Each document is left out of its own sites' sums; its final log odds
are those of its path's prior plus its evidence.

Site tables have a row per site, come from map-side combined sums, and are joined as tables, so a host with a third of all rows is
split by Spark between tasks.

Edge cases: null and empty texts have zero measures; null host or path is a site of its own; null labels and ids train nothing; without
training labels of both kinds the evidence is 0 everywhere; rows with one ``doc_id`` are judged each for itself; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shared import blocks, crc_remainder, stored

MEASURES = ("symbols", "upper", "digits", "bars", "blanks", "distinct_words", "word_length", "length")
BINS = 16
STRONGEST = 1e6
# Bin borders per measure: shares on a logarithmic scale, lengths by powers of two.
_SHARE = np.concatenate(([1e-9], np.geomspace(1e-3, 0.9, BINS - 2)))
_EDGES = {"distinct_words": np.linspace(0.02, 0.98, BINS - 1), "word_length": np.geomspace(2.0, 24.0, BINS - 1), "length": np.geomspace(8, 8 * 2.0 ** (BINS - 2), BINS - 1)}
_UPPER, _DIGIT, _BAR = np.zeros(256), np.zeros(256), np.zeros(256)
_UPPER[65:91] = _DIGIT[48:58] = _BAR[ord("|")] = 1
_BLANK = np.zeros(256)
_BLANK[[9, 10, 11, 12, 13, 32]] = 1
_SYMBOL = np.array([c < 128 and not chr(c).isalnum() and not _BLANK[c] and chr(c) not in ".,;:'\"()-?" for c in range(256)], float)


def measures(text: bytes) -> list[float]:
    """The MEASURES of a text; all zero without characters."""
    counts, words, distinct = np.zeros(256), 0, set()
    for block in blocks(text, b" \t\n\x0b\x0c\r"):
        counts += np.bincount(np.frombuffer(block, np.uint8), minlength=256)
        found = block.split()
        words += len(found)
        distinct.update(map(hash, found))
    size = max(1.0, counts.sum())
    return [counts @ _SYMBOL / size, counts @ _UPPER / size, counts @ _DIGIT / size, counts @ _BAR / size, counts @ _BLANK / size, len(distinct) / max(1, words), (counts.sum() - counts @ _BLANK) / max(1, words), counts.sum()]


def binned(documents: DataFrame) -> DataFrame:
    """doc_id, host, path, bins (bin number by measure) for (doc_id, host, path, text)."""

    def build(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = np.array([measures(t or b"") for t in part.column(3).cast(pa.binary()).to_pylist()]).reshape(-1, len(MEASURES))
                bins = np.stack([np.searchsorted(_EDGES.get(m, _SHARE), rows[:, k], side="right") for k, m in enumerate(MEASURES)], axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.FixedSizeListArray.from_arrays(pa.array(bins.ravel(), pa.int32()), len(MEASURES)).cast(pa.list_(pa.int32()))], names=["doc_id", "host", "path", "bins"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("host").cast("string").alias("host"), F.col("path").cast("string").alias("path"), "text").mapInArrow(build, "doc_id long, host string, path string, bins array<int>")


def evidence(docs: DataFrame, labels: DataFrame) -> tuple[Column, float]:
    """The log ratio of good against bad for a row's bins, and the share of good training rows."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(F.min("quality").cast("int").alias("good"))
    trained = docs.join(known, docs["doc_id"] == known["of"])
    counts = trained.select("good", F.posexplode("bins").alias("measure", "bin")).groupBy("measure", "bin").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))
    seen = np.zeros((len(MEASURES), BINS, 2))
    for r in counts.collect():  # at most MEASURES x BINS rows
        seen[r["measure"], r["bin"]] = r["good"], r["n"] - r["good"]
    good, bad = seen[0].sum(axis=0)
    if not (good and bad):
        return F.lit(0.0), 0.5
    ratio = np.log((seen[..., 0] + 1) / (good + BINS)) - np.log((seen[..., 1] + 1) / (bad + BINS))
    parts = [F.element_at(F.array(*[F.lit(float(x)) for x in ratio[k]]), F.get("bins", k) + 1) for k in range(len(MEASURES))]
    return sum(parts[1:], parts[0]), good / (good + bad)


def _strength(mean_square: float, sampling: float, mean: float) -> float:
    """Pseudo-counts of the level above: large if sites differ no more than chance makes them."""
    between = mean_square - sampling
    return STRONGEST if between <= 0 else float(np.clip(mean * (1 - mean) / between - 1, 1.0, STRONGEST))


def _logit(p: Column) -> Column:
    safe = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    return F.log(safe / (1 - safe))


def _sites(scored: DataFrame, names: list[str]) -> DataFrame:
    return scored.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss"))


def _between(sites: DataFrame, centre: Column) -> tuple[float, float]:
    """Squared distance of site means from their centre, and what sampling alone would make of it, each weighed by the documents."""
    mean = F.col("s") / F.col("n")
    spread = F.greatest(F.lit(0.0), F.col("ss") / F.col("n") - mean * mean) / F.col("n")
    row = sites.agg(F.sum("n").alias("all"), F.sum(F.col("n") * (mean - centre) ** 2).alias("between"), F.sum(F.col("n") * spread).alias("sampling")).first()
    return (row["between"] / row["all"], row["sampling"] / row["all"]) if row["all"] else (0.0, 0.0)


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: doc_id, host, path, held_out, evidence, prior, score (0 to 1, good likelier), predicted (1 from 0.5 on), kept."""
    docs = stored(binned(documents), "binned")
    train = labels.where(crc_remainder(F.col("doc_id"), 5) != 0)
    ratio, base = evidence(docs, train)
    offset = float(np.log(base / (1 - base)))
    scored = stored(docs.select("doc_id", "host", "path", ratio.alias("evidence"), (1 / (1 + F.exp(-(ratio + offset)))).alias("p")), "scored")
    hosts, paths = stored(_sites(scored, ["host"]), "hosts"), stored(_sites(scored, ["host", "path"]), "paths")
    total = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = float(np.clip(total[1] / total[0], 1e-6, 1 - 1e-6)) if total[0] else 0.5
    over_hosts = _strength(*_between(hosts, F.lit(mean)), mean)
    host_of = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    path_of = stored(paths.join(host_of, paths["host"].eqNullSafe(host_of["h"])).drop("h"), "sites")
    host_mean = (F.col("host_s") + over_hosts * mean) / (F.col("host_n") + over_hosts)
    over_paths = _strength(*_between(path_of, host_mean), mean)
    site = path_of.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "host_n", "host_s")
    met = scored.join(site, scored["host"].eqNullSafe(site["h"]) & scored["path"].eqNullSafe(site["q"]))
    without_host = (F.col("host_s") - F.col("p") + over_hosts * mean) / (F.col("host_n") - 1 + over_hosts)
    prior = (F.col("s") - F.col("p") + over_paths * without_host) / (F.col("n") - 1 + over_paths)
    final = 1 / (1 + F.exp(-(_logit(prior) + F.col("evidence"))))
    out = met.select("doc_id", "host", "path", F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "evidence", prior.alias("prior"), final.alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)).withColumn("kept", F.col("score") >= 0.5)
