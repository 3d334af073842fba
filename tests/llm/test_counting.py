"""Lines, phrases and sources counted over all documents, against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canonflow.llm import collocations, line_dedup, source_divergence
from canonflow.llm.quotient_filter import Permutation, QuotientFilter, counted

SCHEMA = "doc_id long, text string, lang string, source string"
COMMON = "The Terms of this service apply, always"


def lines_corpus():
    texts = [
        None, "", "\n", "short\nshort\nshort", f"{COMMON}\nbody one", f"  {COMMON.upper()}\t\nbody two\n{COMMON}", f"x\r\n{COMMON}\r\ny\x0b",
        f"{COMMON}", "é" * 19, "é" * 20, "É" * 20, "é" * 20 + " ", "  " + "é" * 20, "a\n\n\nb", "z" * 50_000 + "\n" + COMMON,
        "A line that only two documents have", "a line THAT only two documents have", "\n".join(f"line number {k} of a long text" for k in range(3000)),
        "line number 7 of a long text\nown", "line number 7 of a long text", "line number 7 of a long text\n" * 3,
    ]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    rows += [(90, f"{COMMON}\nrepeated id", "en", "s"), (90, f"{COMMON}\nrepeated id, other text", "en", "s"), (90, f"{COMMON}\nrepeated id", "en", "s")]
    rows += [(None, f"no id\n{COMMON}", "en", "s")] * 2
    return rows


def brute_lines(rows, least_docs=3, least_chars=20):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    have = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            have[key(line)].add(-1 if i is None else i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        own = -1 if i is None else i
        keep = [line for line in lines if len(key(line)) < least_chars or len(have[key(line)]) < least_docs or max(have[key(line)]) == own]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return Counter(out)


@pytest.mark.parametrize(("docs", "chars"), [(3, 20), (2, 1), (4, 19)])
def test_lines(spark, docs, chars):
    rows = lines_corpus()
    d = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("key", "th", "doc", "gone", "places", "keeper")})
    found = line_dedup.drop_shared_lines(d, docs, chars).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in found) == brute_lines(rows, docs, chars)


def test_lines_of_nothing(spark):
    assert line_dedup.drop_shared_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_rows_send_their_places_once(spark):
    """Many rows of one id and text: what is collected for them is one list."""
    rows = [(None, f"{COMMON}\nsame", "en", "s")] * 3000 + [(k, COMMON, "en", "s") for k in range(3)]
    found = Counter((r.doc_id, r.n_dropped, r.kept_text) for r in line_dedup.drop_shared_lines(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == {(None, 1, "same"): 3000, (0, 1, ""): 1, (1, 1, ""): 1, (2, 0, COMMON): 1}


# phrases


def phrase_corpus():
    rng = np.random.default_rng(5)
    vocabulary = ["New", "york", "city", "the", "of", "Ünter", "x", "New"]
    rows = [(None, None, "en", "s"), (1, "", None, "s"), (2, " \t ", "en", "s"), (3, "...;;;!", "en", "s")]
    for k in range(120):
        some = [vocabulary[j] for j in rng.integers(0, len(vocabulary), 30)]
        text = " ".join(some) + [". ", ";", "\n", " \t", ", "][k % 5] + "san francisco bay area" * (k % 3)
        rows.append((k % 50, text, ["en", None, "und", "de"][k % 4], "s"))
    rows.append((500, "long " * 4000 + "the end", "en", "s"))
    rows += [(600, "again and again", "fr", "s")] * 12
    return rows


def brute_phrases(rows, top, least=10):
    f = defaultdict(Counter)
    for _, t, lang, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                for k in range(len(ws) - n + 1):
                    f[lang if lang is not None else "und"][tuple(ws[k : k + n])] += 1
    out = []
    for lang, c in f.items():
        total = sum(v for g, v in c.items() if len(g) == 1)
        some = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in some.items():
            if any(len(h) == 3 and len(g) == 2 and g in (h[:2], h[1:]) and 100 * b >= 50 * a for h, b in some.items()):
                continue
            score, k = min((1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -s))
    return sorted(out)


@pytest.mark.parametrize(("top", "least", "tiny"), [(2000, 10, False), (5, 3, True)])
def test_phrases(spark, monkeypatch, top, least, tiny):
    rows = phrase_corpus()
    if tiny:  # several blocks, fills and shards for each task
        monkeypatch.setattr(collocations, "BLOCK_BYTES", 500)
        monkeypatch.setattr(collocations, "RUNS", 100)
    d = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("word", "id", "block", "a", "n", "f")})
    found = collocations.collocations(d, top, least, shard_words=50 if tiny else 1 << 20)
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in names) for r in found.collect()) == brute_phrases(rows, top, least)
    assert {found.schema[c].dataType.simpleString() for c in names if c not in ("lang", "phrase")} == {"bigint"}


def test_phrases_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None), (2, "one two", "en", "s")], SCHEMA)).count() == 0


@pytest.mark.parametrize("bits", [2, 3, 24, 64, 81, 127, 128])
def test_permutations_invert(bits):
    p, rng = Permutation(bits), np.random.default_rng(bits)
    hi, lo = (rng.integers(0, 1 << min(b, 63), 500, np.uint64) & np.uint64((1 << b) - 1) for b in (p.left, p.right))
    x, y = p.apply(hi, lo)
    assert int(x.max()) < 1 << p.left and int(y.max()) < 1 << p.right
    assert all(np.array_equal(a, b) for a, b in zip(p.invert(x, y), (hi, lo), strict=True))
    if bits <= 24:  # a bijection
        every = np.arange(1 << bits, dtype=np.uint64)
        x, y = p.apply(every >> np.uint64(p.right), every & np.uint64((1 << p.right) - 1))
        assert len(np.unique((x << np.uint64(p.right)) | y)) == 1 << bits


def test_permutations_have_bounds():
    for bits in (1, 129):
        with pytest.raises(ValueError):
            Permutation(bits)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, (1 << 64) - 1), st.integers(1, 1 << 40)), max_size=200), st.sampled_from([1, 7, 20, 33, 63, 64]), st.integers(1, 4))
def test_filters_lose_nothing(entries, bits, parts):
    some = [(k & ((1 << bits) - 1), n) for k, n in entries]
    filters = []
    for at in range(parts):
        own = some[at::parts]
        filters.append(QuotientFilter(*counted(np.array([k for k, _ in own], np.uint64), np.array([n for _, n in own], np.int64)), bits))
    back = QuotientFilter.merged([QuotientFilter.from_bytes(f.to_bytes()) for f in filters], bits)
    expected = Counter()
    for k, n in some:
        expected[k] += n
    assert dict(zip(back.keys.tolist(), back.counts.tolist(), strict=True)) == expected and back.keys.tolist() == sorted(expected)


def test_filters_are_compact():
    rng = np.random.default_rng(1)
    keys, counts = counted(rng.integers(0, 1 << 40, 100_000).astype(np.uint64))
    assert len(QuotientFilter(keys, counts, 40).to_bytes()) < 5 * len(keys)  # against 16 bytes as plain columns


@pytest.mark.parametrize(("n", "width", "shard_bits"), [(2, 1, 0), (2, 12, 5), (3, 13, 4), (3, 21, 8), (3, 27, 3), (3, 40, 12), (2, 62, 1)])
def test_packed_runs_come_back(n, width, shard_bits):
    rng = np.random.default_rng(width)
    ids = [rng.integers(1, 1 << width, 300).astype(np.uint64) for _ in range(n)]
    p = collocations.Packing(n, width, shard_bits)
    shard, key = p.pack(ids)
    assert p.key_bits <= 64 and int(shard.max()) < 1 << p.shard_bits
    for s in np.unique(shard):
        assert all(np.array_equal(a[shard == s], b) for a, b in zip(ids, p.unpack(int(s), key[shard == s]), strict=True))


def test_frequent_phrases_spread_evenly():
    """Shards depend on the permuted bits, so neighbouring ids don't share one."""
    p = collocations.Packing(2, 20, 6)
    shard, _ = p.pack([np.arange(1, 50_001, dtype=np.uint64), np.full(50_000, 1, np.uint64)])
    assert np.bincount(shard.astype(int), minlength=64).max() < 1.3 * 50_000 / 64


# sources


def source_corpus():
    rng = np.random.default_rng(9)
    terms = [f"t{chr(97 + k)}" for k in range(20)]
    rows = [(1, None, None, None), (2, "", "en", None), (3, "123 !!", "en", "only digits"), (4, "alone", "xx", "s"), (5, "Éa éA ÉA" * 3, "en", "s1")]
    for k in range(150):
        text = " ".join(terms[min(19, int(j))] for j in rng.exponential(2 + k % 5, 25)).title() + " 1x2_y-Z"
        rows.append((k % 70, text, ["en", "de", "", None][k % 4], [f"s{k % 5}", None, ""][k % 7 % 3]))
    rows += [(700, "same same Same", "de", "s1")] * 11
    return rows


def brute_divergence(rows, min_df, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= min_df)

        def shares(some, kept=kept):
            c = Counter(t for d in some for t in d[2])
            total = sum(c[t] for t in kept)
            return c, {t: 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        apart = lambda p, q: (p - q) ** 2 // (p + q)
        by = {s: shares([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        _, whole = shares(own)
        for s, (c, p) in by.items():
            pairs = sorted((-sum(apart(p[t], by[o][1][t]) for t in kept), o.encode()) for o in by if o != s)
            terms = sorted((-apart(p[t], whole[t]), t.encode()) for t in kept if c[t] > 0 and p[t] > whole[t])[:top]
            out += [(lang, s, part, item.decode(), -v, rank) for part, found in (("pair", pairs), ("term", terms)) for rank, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize(("min_df", "top", "shard_terms"), [(10, 10, 1_000_000), (1, 3, 1_000_000), (3, 2, 7)])
def test_divergence(spark, min_df, top, shard_terms, monkeypatch):
    rows = source_corpus()
    if shard_terms < 100:  # several fits
        monkeypatch.setattr(source_divergence, "_shards", lambda *_: 4)
        monkeypatch.setattr(source_divergence, "SUM_ENTRIES", 50)
        monkeypatch.setattr(source_divergence, "BATCH_BYTES", 400)
    d = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("terms", "counts", "shard", "index", "p", "total")})
    found = source_divergence.audit(d, min_df, top, shard_terms)
    names = ("lang", "source", "part", "item", "value", "rank")
    assert sorted(tuple(r[c] for c in names) for r in found.collect()) == brute_divergence(rows, min_df, top)
    assert found.schema["value"].dataType.simpleString() == "bigint" and found.schema["rank"].dataType.simpleString() == "int"


def test_shards_hold_each_vocabulary(spark):
    terms = spark.range(20 * 2000).select(F.concat(F.lit("en w"), (F.col("id") % 2000).cast("string")).alias("tagged"), F.lit(1).alias("df"))
    assert source_divergence._shards(terms, 10, 1_000_000) == 1
    assert 20 < source_divergence._shards(terms, 10, 100) < 45 and source_divergence._shards(terms, 21, 100) == 1


def test_divergence_of_nothing(spark):
    assert source_divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    few = spark.createDataFrame([(1, "a few words", "en", "s"), (2, "more words", "en", "t")], SCHEMA)
    assert sorted((r.source, r.part, r.item, r.value, r["rank"]) for r in source_divergence.audit(few).collect()) == [("s", "pair", "t", 0, 1), ("t", "pair", "s", 0, 1)]


def test_whole_texts_are_read(spark):
    """A very long text in one row."""
    d = spark.createDataFrame([(1, "Alpha beta gamma. " * 300_000, "en", "s"), (2, "alpha beta", "en", "t")], SCHEMA)
    r = {x.phrase: x for x in collocations.collocations(d).collect()}
    assert r["alpha beta gamma"].a == 300_000 and r["alpha beta gamma"].n == 900_002
    assert source_divergence.audit(d, 2).where("part = 'pair'").count() == 2
