"""Source divergence audit: how far each source's words stand from the other sources of its language.

Every document becomes an exact sparse vector of terms and counts. Spark's CountVectorizer, with minDF
and the largest integer as vocabSize, is fitted to the vectors' terms and gives the vocabulary. Terms carry the document's language, so one fit keeps a vocabulary for
each language, with document frequencies counted inside it, however many languages there are. The task
that makes vectors also sums them by (language, source), as Summarizer's buffers do, though in integers.
Tasks' sums are added up and take the vocabulary's indices; terms without one go. That is what summing
the model's own vectors gives, which took more CPU than allowed, as it makes them one by one.

A fitted vocabulary passes through the driver, so its size must be bounded: terms are dealt by hash to
as many shards as hold each to `SHARD_TERMS` kept terms. One shard is fitted as texts are read; of
several, each has its own fit over its own part of the written terms.

The divergence of a source from another sums f(p, q) over all kept terms of the language, p and q
being smoothed shares. It is evaluated sparsely: terms that neither has are alike, so they are
counted; those that one has depend on the other only through its share of an absent term, so they
are summed from a histogram of shares; only terms that both have are joined.

All arithmetic is on integers: shares in decimals of 38 digits, the rest in 64 bits, which
(p - q)**2, at most 10**18, and a sum of f, at most 2 * 10**9 + V, fit.

Defined cases: a null text, lang or source is an empty one; an empty text has no terms but its
(language, source) counts as occurring; rows are documents, so repeated rows count repeatedly; equal
values rank by item in UTF-8 order; a language without kept terms gives pairs of value 0 and no
terms, and one with a single source gives no pairs; other columns are not read; an empty table gives
no rows. A text is held whole by the task that splits it, as its terms, some 70 bytes for each word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scratch
from .coded_words import byte_set, coded, joined
from .common import table, text_or_empty, written
from .words import slices

MIN_DF = 10
TOP = 10
SCALE = 1_000_000_000
#: Terms of one fitted vocabulary, which the driver holds: some 100 MB.
SHARD_TERMS = 1_000_000
BATCH_BYTES = 2 << 20
#: Entries of sums that a task holds before it hands them on.
SUM_ENTRIES = 4_000_000
#: Bytes of distinct terms up to which a written file lists them once.
DICTIONARY_BYTES = 16 << 20
#: The largest vocabulary that can be asked for, and the ASCII characters that end a
#: term; all others belong to one.
MOST_TERMS = (1 << 31) - 1
_IS_TERM = ~byte_set(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of each of `values` over them."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], *(np.add.reduceat(v[order], first) if len(key) else v for v in values)


class _Sums:
    """Vectors summed by (language, source) while a task reads its documents, held by language."""

    def __init__(self):
        self.held: dict[str, list[tuple[pa.Array, list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, sources: list[str], words: pa.Array, row: np.ndarray, code: np.ndarray, counts: np.ndarray) -> None:
        """Entries of some documents, of which `sources` has one for each row."""
        names, number = np.unique(np.array(sources, object), return_inverse=True)
        key, summed, n_docs = _summed(code * len(names) + number[row], counts, np.ones(len(code), np.int64))
        term, source = np.divmod(key, max(1, len(names)))
        self.held[lang].append((words, names.tolist(), term, source, summed, n_docs))
        self.size += len(key)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """names, tagged, df, of, n: for each language its sources, its terms with the number of
        their documents, and for each term the sources (by place in `names`) that have it how often."""
        for lang, parts in self.held.items():
            names = sorted({x for p in parts for x in p[1]})
            place = {x: k for k, x in enumerate(names)}
            found = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
            index = np.split(found.indices.to_numpy(), np.cumsum([len(p[0]) for p in parts])[:-1])
            keys = np.concatenate([own[p[2]].astype(np.int64) * len(names) + np.array([place[x] for x in p[1]], np.int64)[p[3]] for own, p in zip(index, parts, strict=True)])
            key, summed, n_docs = _summed(keys, np.concatenate([p[4] for p in parts]), np.concatenate([p[5] for p in parts]))
            term, source = np.divmod(key, len(names))
            first = np.searchsorted(term, np.arange(len(found.dictionary) + 1))
            df = np.add.reduceat(n_docs, first[:-1]) if len(key) else n_docs
            offsets, whole = pa.array(first.astype(np.int32)), pa.array([0, len(df)], pa.int32())
            lists = [pa.array([names], pa.list_(pa.string()))]
            lists += [pa.ListArray.from_arrays(whole, x) for x in (found.dictionary, pa.array(df), pa.ListArray.from_arrays(offsets, pa.array(source.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(summed)))]
            yield pa.RecordBatch.from_arrays(lists, ["names", "tagged", "df", "of", "n"])
        self.__init__()


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty().alias("text"))


def document_vectors(docs: DataFrame, summed: bool) -> DataFrame:
    """The terms of every document's vector, or what tasks sum up of the vectors (`_Sums.batches`). A
    term follows its language and a space, which no term contains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            for a, b, texts in slices(batch, 2, BATCH_BYTES):
                rows: dict[str, list[int]] = defaultdict(list)
                for k, lang in enumerate(batch.column(0)[a:b].to_pylist()):
                    rows[lang].append(k)
                for lang, own in rows.items():
                    buf, ends = joined([texts[k] for k in own])
                    words, codes, start = coded(buf, _IS_TERM)
                    # The sparse vectors: entries in order of row and term.
                    place = np.repeat(np.arange(len(own)), np.diff(np.searchsorted(start, ends), prepend=0))
                    entry, counts = np.unique(place * max(1, len(words)) + codes, return_counts=True)
                    row, code = np.divmod(entry, max(1, len(words)))
                    tagged = pc.binary_join_element_wise(pa.scalar(lang, pa.large_string()), words, pa.scalar(" ", pa.large_string())).cast(pa.string())
                    if not summed:
                        offsets = pa.array(np.searchsorted(row, np.arange(len(own) + 1)).astype(np.int32))
                        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, tagged.take(pa.array(code)))], ["terms"])
                    elif len(code):
                        sums.add(lang, batch.column(1).take(pa.array([a + k for k in own], pa.int32())).to_pylist(), tagged, row, code, counts)
                if sums.size > SUM_ENTRIES:
                    yield from sums.batches()
        yield from sums.batches()

    kinds = "names array<string>, tagged array<string>, df array<long>, of array<array<int>>, n array<array<long>>"
    return _named(docs).mapInArrow(run, kinds if summed else "terms array<string>")


def _stored(df: DataFrame, label: str) -> DataFrame:
    """`written`, with room for the dictionary of a task's terms, which otherwise would be spelled
    out at each place."""
    path = scratch(df.sparkSession, label)
    df.write.option("parquet.dictionary.page.size", str(DICTIONARY_BYTES)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shards(terms: DataFrame, min_df: int, shard_terms: int) -> int:
    """So many that none keeps more than `shard_terms` terms, of `terms` (tagged, df). Those in enough
    documents are counted among every 64th hash; the estimate has half as many again to spare."""
    one = terms.where(F.pmod(F.xxhash64("tagged"), F.lit(64)) == 0)
    kept = one.groupBy("tagged").agg(F.sum("df").alias("df")).where(F.col("df") >= min_df).count()
    return max(1, -(-96 * kept // shard_terms))


def _dealt(vectors: DataFrame, shards: int) -> DataFrame:
    """terms, shard: each document's terms, once for each shard that it has terms of."""
    if shards == 1:
        return vectors.select("terms", F.lit(0).alias("shard"))
    of = lambda t: F.pmod(F.xxhash64(t), F.lit(shards)).cast("int")
    each = vectors.select("terms", F.explode(F.array_distinct(F.transform("terms", of))).alias("shard"))
    return _stored(each.withColumn("terms", F.filter("terms", lambda t: of(t) == F.col("shard"))), "dealt")


def vocabulary(vectors: DataFrame, shards: int, min_df: int) -> DataFrame:
    """shard, index, tagged, lang, term of every kept term."""
    spark = vectors.sparkSession
    path = scratch(spark, "vocabulary")
    dealt = _dealt(vectors, shards)
    for shard in range(shards):
        model = CountVectorizer(inputCol="terms", minDF=min_df, vocabSize=MOST_TERMS).fit(dealt.where(F.col("shard") == shard))
        model.save(saved := scratch(spark, "model"))
        terms = spark.read.schema("vocabulary array<string>").parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("index", "tagged"))
        split = F.regexp_extract("tagged", "(?s)^(.*) ([^ ]*)$", 1).alias("lang"), F.substring_index("tagged", " ", -1).alias("term")
        terms.select(F.lit(shard).alias("shard"), "index", "tagged", *split).write.mode("append").parquet(path)
    return spark.read.schema("shard int, index int, tagged string, lang string, term string").parquet(path)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms))."""
    wide = lambda c: c.cast("decimal(20,0)")
    return _div(wide(count + 2) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + 2 * terms)) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q))."""
    return _div((p - q) * (p - q), p + q)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language, either way round."""
    side = lambda df, s, keep=(): df.select(*[F.col(c).alias(c if c in keep else f"{c}_{s}") for c in df.columns])
    # Terms that one source has, by how often each share occurs, against an absent term of the other.
    seen = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    others = side(groups, "b", ("lang",))
    met = side(seen, "a", ("lang",)).join(others, "lang").where("source_a != source_b")
    alone = met.groupBy("lang", "source_a", "source_b").agg(F.sum(F.col("n_a") * apart(F.col("p_a"), F.col("absent_b"))).alias("alone"), F.sum("n_a").alias("n"))
    alone = written(alone, "alone")
    # What differs for terms that both have.
    term = ("lang", "shard", "index")
    slim = shares.select(*term, "source", "p", "absent")
    both = side(slim, "a", term).join(side(slim, "b", term), [*term]).where("source_a < source_b")
    c = F.col
    more = apart(c("p_a"), c("p_b")) - apart(c("p_a"), c("absent_b")) - apart(c("absent_a"), c("p_b"))
    common = both.groupBy("lang", "source_a", "source_b").agg(F.sum(more).alias("more"), F.count("*").alias("n_common"))
    # One row for two sources, then one for each way round.
    two = side(groups, "a", ("lang", "kept")).join(side(groups.drop("kept"), "b", ("lang",)), "lang").where("source_a < source_b")
    key = ["lang", "source_a", "source_b"]
    there = alone.select(*key, c("alone").alias("alone_ab"), c("n").alias("n_a"))
    back = alone.select("lang", c("source_b").alias("source_a"), c("source_a").alias("source_b"), c("alone").alias("alone_ba"), c("n").alias("n_b"))
    joined = two.join(there, key, "left").join(back, key, "left").join(common, key, "left")
    zero = lambda name: F.coalesce(c(name), F.lit(0))
    neither = c("kept") - zero("n_a") - zero("n_b") + zero("n_common")
    value = zero("alone_ab") + zero("alone_ba") + zero("more") + neither * F.coalesce(apart(c("absent_a"), c("absent_b")), F.lit(0))
    ways = F.array(F.struct(c("source_a").alias("source"), c("source_b").alias("item")), F.struct(c("source_b").alias("source"), c("source_a").alias("item")))
    return joined.select("lang", value.alias("value"), F.explode(ways).alias("w")).select("lang", "w.source", "w.item", "value")


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: every other source of the language by how
    far it is. Part `term`: the `top` terms that the source has more of than its language."""
    # A row for each term and task, then for each of its sources.
    listed = _stored(document_vectors(docs, summed=True), "sums").select("names", "df", "of", "n", F.posexplode("tagged").alias("at", "tagged"))
    terms = listed.select("tagged", "names", *[F.get(c, F.col("at")).alias(c) for c in ("df", "of", "n")])
    known = vocabulary(document_vectors(docs, summed=False), _shards(terms.select("tagged", "df"), min_df, shard_terms), min_df)
    mine = terms.join(known, "tagged").select("lang", "shard", "index", "term", "names", "n", F.posexplode("of").alias("k", "place"))
    mine = mine.select("lang", F.get("names", F.col("place")).alias("source"), "shard", "index", "term", F.get("n", F.col("k")).alias("n"))
    sums = written(mine.groupBy("lang", "source", "shard", "index", "term").agg(F.sum("n").alias("n")), "sums")
    kept = known.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = _named(docs).select("lang", "source").distinct().join(kept, "lang", "left").join(totals, ["lang", "source"], "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    groups = groups.select("lang", "source", zero("kept"), zero("total"))
    absent = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept")))
    groups = written(groups.withColumn("absent", absent), "groups")
    shares = sums.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    shares = written(shares.select("lang", "source", "shard", "index", "term", "p", "absent"), "shares")
    # The language as a whole.
    whole = sums.groupBy("lang", "shard", "index").agg(F.sum("n").alias("n"))
    sizes = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    whole = whole.join(sizes, "lang").select("lang", "shard", "index", share(F.col("n"), F.col("total"), F.col("kept")).alias("q"))
    more = shares.join(whole, ["lang", "shard", "index"]).where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    terms = ranked(more).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    pairs = ranked(_pairs(groups, shares)).withColumn("part", F.lit("pair"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*names).union(terms.select(*names))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
vs AS (SELECT lang, count(*) AS v FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v ON w.lang = v.lang AND w.term = v.term GROUP BY ALL),
e AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n FROM g JOIN v ON g.lang = v.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
p AS (SELECT e.lang, e.source, e.term, e.n, CAST(1 + (1000000000::HUGEINT * (e.n + 2)) // (sum(e.n) OVER (PARTITION BY e.lang, e.source) + 2 * vs.v) AS BIGINT) AS p
  FROM e JOIN vs ON vs.lang = e.lang),
lt AS (SELECT lang, term, sum(n) AS n FROM e GROUP BY lang, term),
lq AS (SELECT lt.lang, lt.term, CAST(1 + (1000000000::HUGEINT * (lt.n + 2)) // (sum(lt.n) OVER (PARTITION BY lt.lang) + 2 * vs.v) AS BIGINT) AS q
  FROM lt JOIN vs ON vs.lang = lt.lang),
pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pv.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tr AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p.p - lq.q) * (p.p - lq.q) // (p.p + lq.q) AS BIGINT) AS value
  FROM p JOIN lq ON p.lang = lq.lang AND p.term = lq.term WHERE p.n > 0 AND p.p > lq.q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM tr))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""
