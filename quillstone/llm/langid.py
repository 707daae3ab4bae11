"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied as likelihoods (added in logs): the text's words and letter n-grams under naive
Bayes models, the language that the markup declares, the address suffix (the host's last label and a language folder
of the path), and a prior for the host. Only the text models are trained with labels, on a bounded sample of the
labelled documents (TRAIN_DOCS). All else is counted over the whole table: a grouped aggregation sums the pages' text
posteriors by declared language, by suffix and by host, so that an unreliable attribute earns little weight. The host
prior is smoothed hierarchically: towards its domain, the domain towards the whole corpus. A page's own posterior is
taken out of its host's and domain's sums first, so no page votes for itself.

Text likelihoods are tempered (TEMPER), as n-grams of one page aren't independent. A null or empty page has no text
evidence and gets what the other evidence says; a null address has its own host group; a page without any evidence
gets the corpus prior. Pages are read whole, in time by their length, however broken their markup is. Ties go to the first language in code-point order. Repeated rows give repeated results. Extra
columns pass through the text step only if asked for. Sums by host are partial before the shuffle, and the join back
carries narrow rows, so a hot host is no hot task.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written

TRAIN_DOCS = 4000
BINS = 1 << 15
TEMPER = 0.2
#: Pseudo-counts of a host towards its domain, and of a domain towards the corpus; and of attribute tables.
HOST_WEIGHT, DOMAIN_WEIGHT, ATTRIBUTE_WEIGHT = 5.0, 5.0, 2.0

_RAW = re.compile(r"<(script|style)\b", re.IGNORECASE)
_CLOSE = {n: re.compile(f"</{n}\\s*>", re.IGNORECASE) for n in ("script", "style")}
_WORDS = re.compile(r"[^\W\d_]+")


def text_of(page: str) -> str:
    """A page without tags, comments, scripts and styles, an unclosed one of these with all behind it; in one pass."""
    parts, at = [], 0
    while (low := page.find("<", at)) >= 0:
        parts.append(page[at:low])
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            at = end + 3 if end >= 0 else len(page)
        elif m := _RAW.match(page, low):
            close = _CLOSE[m[1].lower()].search(page, m.end())
            at = close.end() if close else len(page)
        elif (end := page.find(">", low)) >= 0:
            at = end + 1
        else:
            at = low
            break
    return html.unescape(" ".join([*parts, page[at:]]))


def grams(text: str, bins: int = BINS) -> np.ndarray:
    """The bins of a text's words and of their letter pairs and triples."""
    out: list[int] = []
    known: dict[str, list[int]] = {}
    for word in _WORDS.findall(text.lower()):
        own = known.get(word)
        if own is None:
            w = f"<{word}>"
            parts = [w, *(w[i : i + 2] for i in range(len(w) - 1)), *(w[i : i + 3] for i in range(len(w) - 2))]
            own = known[word] = [zlib.crc32(x.encode()) % bins for x in parts]
        out += own
    return np.array(out, np.int64)


def train(docs: DataFrame, most: int = TRAIN_DOCS, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages, and the log-likelihood of each gram under each, from at most `most` labelled documents.

    The sample is those with the least hash, so reruns agree; it is the only part that doesn't cover all rows. Texts stay
    on the executors; the driver gets hashes of the sample's size, and at most BINS counts a language.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    labelled = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64("doc_id", lang, text).alias("hash"))
    least = [r[0] for r in labelled.select("hash").orderBy("hash").limit(most).collect()]
    if not least:
        return [], np.zeros((0, BINS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: dict[str, np.ndarray] = {}
            for own, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.setdefault(own, np.zeros(BINS, np.int64))
                counts[own] += np.bincount(grams(t), minlength=BINS)
            for own, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(at), pa.string()), pa.array(at), pa.array(c[at])], names=["lang", "bin", "n"])

    sample = labelled.filter(F.col("hash") <= least[-1]).select("lang", "text")
    rows = sample.mapInArrow(run, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    names, bins, n = rows.column("lang").to_pylist(), rows.column("bin").to_numpy(), rows.column("n").to_numpy()
    langs = sorted(set(names))
    counts = np.full((len(langs), BINS), 0.5)
    place = {x: i for i, x in enumerate(langs)}
    counts[[place[x] for x in names], bins] += n
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True))


def text_evidence(pages: DataFrame, langs: list[str], model: np.ndarray, page: str = "html") -> DataFrame:
    """Adds ll, the tempered log-likelihoods of the page's text in the order of langs."""
    known = pages.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            out = []
            for x in batch.column(page).to_pylist():
                g = grams(text_of(x or ""))
                ll = TEMPER * known.value[:, g].sum(axis=1, dtype=np.float64)
                out.append(np.round(ll - ll.max(), 6).tolist())
            kept = [n for n in batch.schema.names if n != page]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array(out, pa.list_(pa.float64()))], names=[*kept, "ll"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != page)
    return pages.mapInArrow(run, f"{kept}, ll array<double>")


def _total(values: Column | str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _softmax(ll: Column) -> Column:
    raised = F.transform(ll, lambda x: F.exp(x - F.array_max(ll)))
    total = _total(raised)
    return F.transform(raised, lambda x: x / total)


def _sums(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """An array of the sums of the posteriors by keys, in millionths so that their order doesn't matter."""
    each = df.select(*keys, F.posexplode("millionths").alias("_at", "_of")).groupBy(*keys, "_at").agg(F.sum("_of").alias("_of"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_of"))), lambda x: x["_of"]).alias(name))  # a value a language


def identify(pages: DataFrame, docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(page_id, url, lang, confidence) for each page."""
    langs, model = train(docs, most)
    n = len(langs)
    first = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)^.*?<html\b([^>]*)", 1)
    declared = F.lower(F.regexp_extract(first, r"(?i)\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    folder = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]+://[^/]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    rows = pages.select("page_id", "url", "html", declared.alias("declared"), host.alias("host"), F.concat_ws("/", F.regexp_extract(host, r"([^.]*)$", 1), folder).alias("suffix"))
    rows = rows.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
    if not n:
        return rows.select("page_id", "url", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"))
    seen = text_evidence(rows, langs, model)
    seen = seen.withColumn("millionths", F.transform(_softmax(F.col("ll")), lambda p: F.round(p * 1_000_000).cast("long")))
    seen = written(seen, "language-evidence")
    out = seen.crossJoin(F.broadcast(_sums(seen, [], "c")))  # one row
    for keys, name in ((["host"], "h"), (["domain"], "d"), (["declared"], "m"), (["suffix"], "s")):
        out = out.join(_sums(seen, keys, name), keys, "left")
    # shares of a page; a page's own evidence is no evidence about its host
    out = out.withColumns({k: F.transform(k, lambda x: x / 1e6) for k in "cms"} | {k: F.zip_with(k, "millionths", lambda x, y: (x - y) / 1e6) for k in "hd"})
    out = out.withColumns({f"{k}_all": _total(k) for k in "cmshd"})
    out = out.withColumn("base", F.transform("c", lambda x: (x + 1) / (F.col("c_all") + n)))
    places = F.sequence(F.lit(0), F.lit(n - 1))

    def score(i: Column) -> Column:
        base = F.get("base", i)
        domain = (F.get("d", i) + DOMAIN_WEIGHT * base) / (F.col("d_all") + DOMAIN_WEIGHT)
        prior = (F.get("h", i) + HOST_WEIGHT * domain) / (F.col("h_all") + HOST_WEIGHT)
        total = F.get("ll", i) + F.log(prior)
        for name in "ms":  # how much likelier the attribute is in this language than overall
            share = (F.get(name, i) + ATTRIBUTE_WEIGHT * base) / (F.col(f"{name}_all") + ATTRIBUTE_WEIGHT)
            total += F.log(share / base)
        return F.round(total, 6)

    posterior = out.withColumn("scores", F.transform(places, score)).withColumn("posterior", _softmax(F.col("scores")))
    best = F.array_position("scores", F.array_max("scores")) - 1
    return posterior.select("page_id", "url", F.get(F.array(*[F.lit(x) for x in langs]), best.cast("int")).alias("lang"), F.round(F.array_max("posterior"), 4).alias("confidence"))
