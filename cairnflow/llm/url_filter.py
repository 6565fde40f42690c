"""URL verdicts: rules first, then words of host and path under multinomial naive Bayes.

Hosts are concatenated names; a unigram model over the words of all pages splits them by
Viterbi. The Bayes model is counted on urls that a rule judges (their verdicts are its
labels) and judges the rest.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, discard, keep, session_of, table, worker_store
from .registry import query

#: (verdict, host and path) as the contract names them.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Part of all page words that a word of the unigram model is at least, so it has at most 1 / RARE words; and
#: distinct judged urls that the Bayes model is counted on.
RARE = 1e-6
LABELLED = 100_000
REMEMBER = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or end, A-Z lower-cased; path: then up to `?`, `#` or end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring({0}, {1} + 3)".format("url", "locate('://', url)"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a subdomain of it, and the start of the path."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # later, longer ones win
        own, start = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find, tags, total = re.compile(rb"[a-z]+").findall, re.compile(rb"<[^>]*>").sub, Counter()
    for batch in batches:
        for raw in pc.fill_null(batch.column("html"), "").cast(pa.binary()).to_pylist():
            total.update(find(tags(b" ", raw).lower()))
        if len(total) > 1_000_000:
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def unigrams(df: DataFrame, html: str = "html", rare: float = RARE) -> dict[str, float]:
    """Log probabilities among all words of all pages, of those words that are at least ``rare`` of them."""
    session_of(df)
    counted = keep(df.select(F.col(html).alias("html")).mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "page-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    logs = {r.word: math.log(r.n / total) for r in counted.where(F.col("n") >= rare * total).collect()} if total else {}
    discard(counted)
    return logs | {"": -math.log(total or 1)}


def segment(name: str, logs: dict[str, float], sizes: list[int] | None = None) -> list[str]:
    """The likeliest words of a run of letters; an unknown word of k letters counts as 1 in total * 10**k.

    ``sizes`` are the lengths that words of ``logs`` have. Unknown words may have any length:
    their best start is carried along. Ties go to the later start, a known word first.
    """
    if sizes is None:
        sizes = sorted({len(w) for w in logs if w})
    unknown, ten = logs[""], math.log(10)
    best, back = [0.0], [0]
    open_score, open_at = 0.0, 0  # the best score less what letters cost, and its place
    for end in range(1, len(name) + 1):
        score, start = open_score + unknown - ten * end, open_at
        for size in sizes:
            if size > end:
                break
            known = logs.get(name[end - size : end])
            if known is not None and (best[end - size] + known, end - size) >= (score, start):
                score, start = best[end - size] + known, end - size
        best.append(score)
        back.append(start)
        if score + ten * end >= open_score:
            open_score, open_at = score + ten * end, end
    words, at = [], len(name)
    while at:
        words.append(name[back[at] : at])
        at = back[at]
    return words[::-1]


class _Tokens:
    def __init__(self, logs: dict[str, float]):
        self.logs, self.words = logs, {}
        self.sizes = sorted({len(w) for w in logs if w})

    def _split(self, run: str) -> list[str]:
        words = self.words.get(run)
        if words is None:
            if len(self.words) > REMEMBER:
                self.words.clear()
            words = self.words[run] = segment(run, self.logs, self.sizes) if run.isalpha() else [f"{len(run)} digits"]
        return words

    def of(self, host: str, path: str) -> list[str]:
        """Tokens of host and path, marked by where they stand; digits count by their number."""
        out = []
        for mark, text in (("h", host), ("p", path.lower())):
            for run in re.findall(r"[a-z]+|[0-9]+", text):
                out += [f"{mark}:{w}" for w in self._split(run)]
        labels = host.rsplit(".", 1)
        return [*out, f"t:{labels[-1]}"] if host else out


def fit_bayes(rows: list[tuple[str, str, str, int]], logs: dict[str, float]) -> dict:
    """Token weights (log odds of block) from (host, path, verdict, how often)."""
    tokens, counts = _Tokens(logs), {"block": Counter(), "allow": Counter()}
    docs: Counter = Counter()
    for host, path, verdict, n in rows:
        for token in tokens.of(host, path):
            counts[verdict][token] += n
        docs[verdict] += n
    vocabulary = set(counts["block"]) | set(counts["allow"])
    size = {k: sum(c.values()) + len(vocabulary) for k, c in counts.items()}
    odds = {w: math.log((counts["block"][w] + 1) / size["block"]) - math.log((counts["allow"][w] + 1) / size["allow"]) for w in vocabulary}
    return {"odds": odds, "prior": math.log((docs["block"] + 1) / (docs["allow"] + 1))}


def judge(df: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row.

    A null url or one without `://` has an empty host and path, no rule, and the verdict of
    the prior. Where no rule judges any url, the method allows everything. ``score`` is the
    method's probability of block, null where a rule decides. Repeated rows are judged alike;
    an empty table gives no rows; null ids pass; other columns are not looked at.
    """
    session_of(df)
    logs = unigrams(df, html)
    plain = df.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    parted = plain.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parted.withColumn("rule", rule).withColumn("ruled", verdict)
    labelled = ruled.where("ruled IS NOT NULL").groupBy("host", "path", "ruled").agg(F.count("*").alias("n"))
    sample = bounded_sample(labelled, F.xxhash64(F.lit(9), "host", "path"), LABELLED)
    model = fit_bayes([tuple(r) for r in sample.collect()], logs)
    name = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("urls")
        if store.get("model") != name:
            store["model"], store["tokens"] = name, _Tokens(logs)
        tokens, odds = store["tokens"], model["odds"]
        for batch in batches:
            found: list[float | None] = []
            for h, p, r in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), batch.column("ruled").to_pylist(), strict=True):
                z = model["prior"] + sum(odds.get(t, 0.0) for t in tokens.of(h, p)) if r is None else None
                found.append(None if z is None else 1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "score"])

    out = ruled.mapInArrow(score, T.StructType(list(ruled.schema)).add("score", T.DoubleType()))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")


@query("op5_url_filter")
def op5_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))
