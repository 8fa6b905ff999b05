"""Language ID: Bayesian fusion of text, declared markup language, address suffix and host priors.

Text: byte trigrams of the whole lower-cased text under one smoothed multinomial per language,
counted over all rows that declare a language, tempered because trigrams overlap. Evidence: how
often texts of each language declare what they declare, and sit under which address suffix. Prior:
language shares of the host, smoothed towards its domain, smoothed towards all. The shares and
confusions come from grouped aggregation of each row's best language by text alone. The extra
hypothesis ``und`` has uniform trigrams and no preference in any evidence.

Every declared language is a candidate, however many there are and however few rows declare it;
smoothing alone weighs rare ones. Counts are kept sparse: the model on the driver and in the
workers has at most 16,384 trigram buckets a language, and a batch one number per row and language.
A declaration of ``und`` is none. Trigrams with digits or marks are no evidence. Null or
empty texts, and texts without a telling trigram, are ``und``. Null declarations and addresses are
no evidence. Rows are judged one by one; extra columns stay; an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import flat, pieces, ranges, table, text_batches
from zonalis.session import stage

BUCKETS = 1 << 14
ENTRIES = 1 << 20
TEMPER = 1 / 3
STRENGTH = 20.0  # rows that a parent's shares count for
CLAIMS = 5.0  # rows that equal declarations count for in each language
HELD = 64  # languages that a task counts before it sends their counts on
UNKNOWN = "und"
UNKNOWN_SHARE = 0.01

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
#: Bytes that speak for a language: letters, all of other characters, and what parts words.
_SPEAKS = np.zeros(256, bool)
_SPEAKS[[*b" \n\t'", *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that starts at each byte but the last two."""
    d = _LOWER[data]
    code = (d[:-2] << 16) | (d[1:-1] << 8) | d[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(18)


def _telling(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which of the trigrams lie within one row and hold no digits or marks, which all languages share."""
    own = _SPEAKS[data]
    ok = own[:-2] & own[1:-1] & own[2:]
    for back in (1, 2):
        cut = bounds[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return ok


def declared(column: str) -> Column:
    """The primary language of a declaration such as ``pt-BR``; empty ones and ``und`` are null."""
    name = F.lower(F.regexp_extract(F.col(f"`{column}`"), r"^\s*([A-Za-z]{2,8})", 1))
    return F.nullif(F.nullif(name, F.lit("")), F.lit(UNKNOWN))


COUNTS = "language string, buckets binary, counts binary"


def _packed(total: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The counts that are not zero, a row per language."""
    at = [np.flatnonzero(t) for t in total.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(total, pa.string()), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()),
         pa.array([t[a].astype("<i8").tobytes() for a, t in zip(at, total.values(), strict=True)], pa.binary())],
        ["language", "buckets", "counts"])


def trigram_counts(rows: DataFrame, languages: list[str] | None = None) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Buckets and counts of each declared language (or of ``languages``) over all rows that declare one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            names, which = np.unique(batch.column("declared").to_pylist(), return_inverse=True)
            data, bounds = flat(batch.column("text"))
            for start, stop in pieces(bounds):
                part = bounds[start : stop + 1]
                text, edge = data[part[0] : part[-1]], part - part[0]
                # rows by language, so that each language's trigrams lie together
                owner = np.repeat(which[start:stop].astype(np.min_scalar_type(len(names))), np.diff(edge))
                if len(text) > 2:
                    ok = _telling(text, edge)
                    owner, code = owner[: len(ok)][ok], trigrams(text)[ok]
                else:
                    owner, code = owner[:0], np.empty(0, np.int64)
                order = np.argsort(owner, kind="stable")
                owner, code = owner[order], code[order].astype(np.int64)
                present = np.unique(which[start:stop])
                for i, a, b in zip(present, np.searchsorted(owner, present), np.searchsorted(owner, present, "right"),
                                   strict=True):
                    found = np.bincount(code[a:b], minlength=BUCKETS)
                    name = str(names[i])
                    total[name] = total[name] + found if name in total else found
                    if len(total) >= HELD:
                        yield _packed(total)
                        total = {}
        yield _packed(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for row in batch.select(["language", "buckets", "counts"]).to_pylist():
                name = row["language"]
                total[np.frombuffer(row["buckets"], "<u2")] += np.frombuffer(row["counts"], "<i8")
        if name is not None:
            yield _packed({name: total})

    known = rows.where("declared IS NOT NULL" if languages is None else F.col("declared").isin(languages))
    parts = known.select("declared", "text").mapInArrow(count, COUNTS)
    # in two levels, so that no task reads all parts of a language
    some = parts.withColumn("salt", F.spark_partition_id() % 16).groupBy("language", "salt").applyInArrow(add, COUNTS)
    summed = some.groupBy("language").applyInArrow(add, COUNTS)
    return {r["language"]: (np.frombuffer(r["buckets"], "<u2"), np.frombuffer(r["counts"], "<i8"))
            for r in summed.collect()}  # a row per language


class Model:
    """Log likelihoods of trigrams by language, sparse, and last of ``und``.

    A bucket that a language never has adds ``base``; one that it has ``c`` times adds log(1 + 2c) more.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], languages: list[str]):
        nothing = np.empty(0, np.int64)
        found = [counts.get(x, (nothing, nothing)) for x in languages]
        buckets = np.concatenate([b for b, _ in found]).astype(np.int64)
        order = np.argsort(buckets, kind="stable")
        self.first = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))  # the entries of each bucket
        self.language = np.repeat(np.arange(len(found), dtype=np.int32), [len(b) for b, _ in found])[order]
        self.gain = np.log1p(2.0 * np.concatenate([c for _, c in found]))[order]
        total = np.array([c.sum() for _, c in found], float)
        self.base = np.concatenate([np.log(0.5 / (total + 0.5 * BUCKETS)), [-np.log(BUCKETS)]])

    def likelihoods(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log likelihoods by row and language, and which rows have a telling trigram."""
        width = len(self.base)
        data, bounds = flat(column)
        told = np.zeros(len(bounds) - 1, np.int64)
        found = np.zeros((len(told), width))
        for start, stop in pieces(bounds):
            part = bounds[start : stop + 1]
            raw, edge = data[part[0] : part[-1]], part - part[0]
            if len(raw) < 3:
                continue
            ok = _telling(raw, edge)
            row = np.repeat(np.arange(stop - start), np.diff(edge))[: len(ok)][ok]
            code = trigrams(raw)[ok].astype(np.int64)
            told[start:stop] = np.bincount(row, minlength=stop - start)
            size = self.first[code + 1] - self.first[code]
            ends = np.cumsum(size)
            at = 0
            while at < len(code):  # some trigrams at a time, as each has an entry per language that has it
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, "right")))
                entry = ranges(self.first[code[at:to]], size[at:to])
                low = row[at]
                cell = np.repeat((row[at:to] - low) * width, size[at:to]) + self.language[entry]
                high = row[to - 1] + 1
                sums = np.bincount(cell, self.gain[entry], (high - low) * width)
                found[start + low : start + high] += sums.reshape(-1, width)
                at = to
        found += told[:, None] * self.base
        return TEMPER * found, told > 0


def best_by_text(df: DataFrame, sent, text: str, out: str = "best") -> DataFrame:
    """All columns plus ``out``: the number of the likeliest language by text alone, null without a trigram."""

    @F.arrow_udf("int")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, heard = sent.value.likelihoods(batch)
            yield pa.array(found[:, :-1].argmax(axis=1), pa.int32(), mask=~heard)

    return df.withColumn(out, best(F.col(f"`{text}`")))


def _counts(rows: DataFrame, by: str) -> DataFrame:
    """For each value, how many rows have which best language: pairs of language number and count."""
    pairs = rows.where(F.col(by).isNotNull()).groupBy(by, "best").agg(F.sum("n").alias("n"))
    return pairs.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("best", "n"))).alias("c")).select(
        by, F.col("c.best").alias(f"{by}_best"), F.col("c.n").alias(f"{by}_n"))


class Evidence:
    """Shares of all rows and, sparse, how often texts of each language declare what."""

    def __init__(self, total: dict[int, int], said: list, languages: list[str]):
        n = len(languages)
        self.overall = np.array([total.get(i, 0) + 1.0 for i in range(n)])
        self.overall /= self.overall.sum()
        self.each = CLAIMS / (n + 1)
        self.by_said, self.all = {}, np.full(n, CLAIMS)
        known = set(languages)
        for r in said:
            name = r["declared"] if r["declared"] in known else None
            self.by_said.setdefault(name, []).append((r["best"], r["n"]))
            self.all[r["best"]] += r["n"]
        self.known = known

    def spoken(self, name: str) -> np.ndarray:
        """Log P(declaration | language)."""
        counts = np.full(len(self.all), self.each)
        for best, n in self.by_said.get(name if name in self.known else None, ()):
            counts[best] += n
        return np.log(counts / self.all)

    def shares(self, best: pa.Array, n: pa.Array, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares by row smoothed towards the parent's, and which rows have counts."""
        counts = np.zeros((len(best), len(self.overall)))
        sizes = np.array([len(x) if x.is_valid else 0 for x in best], np.int64)
        row = np.repeat(np.arange(len(best)), sizes)
        counts[row, best.flatten().to_numpy(zero_copy_only=False).astype(np.int64)] = n.flatten().to_numpy(zero_copy_only=False)
        return (counts + STRENGTH * parent) / (counts.sum(axis=1, keepdims=True) + STRENGTH), sizes > 0


PLACES = ("host", "domain", "suffix")


def evidence_tables(scored: DataFrame, languages: list[str]) -> tuple[DataFrame, Evidence]:
    """By host, the counts of its best languages, of its domain's and its suffix's; and what holds for all.

    The counts are one small row per host, declaration and language; a hot host is summed before
    the shuffle.
    """
    rows = stage(
        scored.where("best IS NOT NULL").groupBy("host", "domain", "suffix", "declared", "best").agg(
            F.count("*").alias("n")), "languages")
    total = {r["best"]: r["n"] for r in rows.groupBy("best").agg(F.sum("n").alias("n")).collect()}
    said = rows.where("declared IS NOT NULL").groupBy("declared", "best").agg(F.sum("n").alias("n")).collect()
    names = rows.groupBy("host").agg(F.max("domain").alias("domain"), F.max("suffix").alias("suffix"))
    hosts = (
        _counts(rows, "host").join(names, "host").join(_counts(rows, "domain"), "domain", "left")
        .join(_counts(rows, "suffix"), "suffix", "left")
        .select("host", *[f"{p}_{x}" for p in PLACES for x in ("best", "n")])
    )
    return stage(hosts, "hosts"), Evidence(total, said, languages)


def identify(df: DataFrame, text: str = "text", declaration: str | None = None, host: str | None = None,
             domain: str | None = None, suffix: str | None = None, languages: list[str] | None = None,
             shares: bool = True) -> DataFrame:
    """All columns plus ``language``, ``posterior`` and, with ``shares``, ``posteriors`` (by language, ``und`` last).

    ``declaration``, ``host``, ``domain`` and ``suffix`` name string columns; those left out, and
    nulls, are no evidence.
    """
    named = lambda c: F.col(f"`{c}`") if c else F.lit(None).cast("string")
    said = declared(declaration) if declaration else F.lit(None).cast("string")
    own = df.select(
        F.col(f"`{text}`").alias("text"), said.alias("declared"), F.lower(named(host)).alias("host"),
        F.lower(named(domain)).alias("domain"), F.lower(named(suffix)).alias("suffix"),
    )
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), said.alias("declared"),
        F.lower(named(host)).alias("host"))
    spark = df.sparkSession
    text_batches(spark)
    counts = trigram_counts(own, languages)
    found = sorted(languages or counts)
    new = ["language", "posterior", *["posteriors"] * shares]
    if not found:
        values = [F.lit(UNKNOWN), F.lit(1.0), F.array(F.lit(1.0))]
        return df.withColumns(dict(zip(new, values, strict=False)))
    model = spark.sparkContext.broadcast(Model(counts, found))
    hosts, told = evidence_tables(best_by_text(own, model, "text").drop("text"), found)
    evidence = spark.sparkContext.broadcast(told)
    names = np.array([*found, UNKNOWN], object)
    fields = ["string", "double", "array<double>"][: len(new)]

    @F.arrow_udf("struct<" + ",".join(f"{n}:{t}" for n, t in zip(new, fields, strict=True)) + ">")
    def judge(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known_of = evidence.value
        for texts, claims, *pairs in batches:
            score, heard = model.value.likelihoods(texts)
            prior, _ = known_of.shares(*pairs[2:4], known_of.overall)
            prior, _ = known_of.shares(*pairs[:2], prior)
            of_suffix, placed = known_of.shares(*pairs[4:], known_of.overall)
            at_host = np.array([x.is_valid for x in pairs[0]], bool)
            known = np.log(np.where(at_host[:, None], prior, known_of.overall)) + np.log(1 - UNKNOWN_SHARE)
            known += np.where(placed[:, None], np.log(of_suffix / known_of.overall), 0.0)
            claims = np.array(claims.to_pylist(), object)
            for name in set(claims) - {None}:
                known[claims == name] += known_of.spoken(name)
            # ``und``: its text likelihood, and the evidence it would have if every language were as likely
            score[:, :-1] += known
            score[:, -1] += known.mean(axis=1) + np.log(UNKNOWN_SHARE)
            weights = np.exp(score - score.max(axis=1, keepdims=True))
            weights /= weights.sum(axis=1, keepdims=True)
            weights[~heard] = np.arange(len(names)) == len(found)
            made = [pa.array(names[weights.argmax(axis=1)], pa.string()), pa.array(weights.max(axis=1))]
            if shares:
                edges = np.arange(len(weights) + 1, dtype=np.int32) * len(names)
                made.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(weights.ravel())))
            yield pa.StructArray.from_arrays(made, new)

    # the staged table's size is known, so Spark sends it to all tasks only where it is small
    joined = whole.join(hosts, "host", "left")
    judged = joined.withColumn("__judged", judge(
        F.col("__row")[text], F.col("declared"), *[F.col(f"{p}_{x}") for p in PLACES for x in ("best", "n")]))
    return judged.select(
        *[F.col("__row")[c].alias(c) for c in df.columns if c not in new],
        *[F.col("__judged")[c].alias(c) for c in new],
    )


def kept(threshold: float = 0.5) -> Column:
    """A known language with at least this posterior."""
    return (F.col("language") != UNKNOWN) & (F.col("posterior") >= threshold)


def keep_known(df: DataFrame, threshold: float = 0.5, **columns) -> DataFrame:
    """The rows of a known language, with the columns they came with."""
    own = [f"c{i}" for i in range(len(df.columns))]
    places = {k: own[df.columns.index(v)] for k, v in columns.items()}
    judged = identify(df.toDF(*own), text=own[df.columns.index("text")], shares=False, **places)
    return judged.where(kept(threshold)).select(*[F.col(o).alias(c) for o, c in zip(own, df.columns, strict=True)])


def page_fields(pages: DataFrame) -> DataFrame:
    """Text, declared language and address parts of raw pages."""
    hidden = r"(?is)<!--.*?-->|<(script|style|noscript)\b.*?</\1\s*>"
    text = F.regexp_replace(F.regexp_replace("html", hidden, " "), r"(?s)<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return pages.select(
        "page_id", F.regexp_replace(text, r"&[#\w]+;", " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1).alias("markup"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit("")).alias("suffix"),
    )


def op8_language(spark, sf_dir):
    """Language of every document: the column ``lang`` declares, the source is the host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = identify(docs, declaration="lang", host="source", shares=False)
    return judged.select("doc_id", "language", "posterior", kept().alias("kept"))


def pages_language(spark, sf_dir):
    """Language of every raw page from its text, markup, address suffix and host."""
    judged = identify(page_fields(table(spark, sf_dir, "pages")), declaration="markup", host="host", domain="domain",
                      suffix="suffix", shares=False)
    return judged.select("page_id", "markup", "host", "language", "posterior", kept().alias("kept"))
