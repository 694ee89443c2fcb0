"""Fingerprints and classifiers against plain computations, and the whole pipeline
against its stages done by brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martlake.llm import decontam, fingerprints, jaccard, langid, lm, packing, quality, toxicity
from martlake.llm.queries import tokenizer_path

BASE = ("the quick brown fox jumps over the lazy dog while seven wise owls count silver coins near an old stone mill "
        "under pale moonlight and quiet rivers carry fallen leaves toward distant shores where tired sailors mend nets "
        "before dawn breaks softly across green hills").split()


def naive_signature(text, sketches=fingerprints.SKETCHES, picks=fingerprints.PICKS):
    """Minimal occurrence-numbered k-mers of each bin, put back in text order."""
    codes = fingerprints.codes_of(text)
    if not len(codes):
        return [()] * sketches
    h = fingerprints._kmers(codes, fingerprints.K)
    seen, rows = Counter(), []
    mask = (1 << 24) - 1
    for pos, x in enumerate(int(v) & ~mask for v in h):
        n = seen[x]
        seen[x] += 1
        with np.errstate(over="ignore"):
            key = x if not n else int(fingerprints.mix64(np.array([x >> 24], np.uint64) + np.uint64(n) * fingerprints.GOLDEN)[0]) & ~mask
        rows.append((key, pos))
    bins = [[] for _ in range(sketches)]
    for key, pos in rows:
        bins[key >> (64 - (sketches - 1).bit_length())].append((key, pos))
    return [tuple(k for k, _ in sorted(sorted(b)[:picks], key=lambda r: r[1])) for b in bins]


@pytest.mark.parametrize("text", ["", "a", "abcdefgh", "abcabc" * 40, " ".join(BASE), " ".join(BASE * 3), "été " * 30 + "fin"])
def test_signatures_hash_the_ordered_minimal_kmers(text):
    got, want = fingerprints.signature(fingerprints.codes_of(text)), naive_signature(text)
    assert [g == 0 for g in got] == [w == () for w in want]
    other = text[len(text) // 3:] + text[: len(text) // 3]
    b, c = fingerprints.signature(fingerprints.codes_of(other)), naive_signature(other)
    assert [int(x) == int(y) for x, y in zip(got, b, strict=True)] == [x == y for x, y in zip(want, c, strict=True)]


def test_ordinal_weights_are_the_likelihoods_optimum():
    rng = np.random.default_rng(5)
    docs, words = 400, 12
    toxic = np.arange(docs) % 4 == 0
    rows = [(d, w) for d in range(docs) for w in range(words) if rng.random() < (0.5 if toxic[d] and w < 4 else 0.12)]
    doc, word = (np.array(c) for c in zip(*rows, strict=True))
    model = toxicity.Ordinal().fit(doc, word.astype(np.uint64), np.ones(len(doc), np.int64), toxic, 0.25)
    assert set(model.words.tolist()) <= {0, 1, 2, 3} and len(model.words) >= 3 and (np.diff(model.thresholds) > 0).all()
    keep = np.isin(word, model.words)
    col, row = np.searchsorted(model.words, word[keep]), doc[keep]
    hits = np.bincount(row, minlength=docs)
    cuts = np.quantile(hits[toxic & (hits > 0)], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + np.searchsorted(cuts, hits, "left"), 0)
    shift = math.log(0.25 / 0.75) - math.log(toxic.sum() / (~toxic).sum())

    def loss(w, cut):  # plain negative log likelihood, document by document
        s = np.bincount(row, weights=np.log1p(1.0) * w[col], minlength=docs)
        total = 0.0
        for d in range(docs):
            at_least = [1.0] + [1 / (1 + math.exp(-(s[d] - c))) for c in cut] + [0.0]
            total -= math.log(max(at_least[grade[d]] - at_least[grade[d] + 1], 1e-9))
        return total / docs + 0.5e-5 * float(w @ w)
    best = loss(model.w, model.thresholds + shift)
    for step in (0.05, -0.05):
        for i in range(len(model.w)):
            w = model.w.copy()
            w[i] += step
            assert loss(w, model.thresholds + shift) >= best - 1e-4
        for i in range(3):
            cut = model.thresholds + shift
            cut[i] += step
            assert loss(model.w, cut) >= best - 1e-4


def test_toxicity_of_odd_rows(spark):
    rows = [(i, " ".join(BASE[i % 9: i % 9 + 15]) + f" n{i}" + (" vile scoundrel" if i % 5 == 0 else "")) for i in range(200)]
    odd = [(None, "vile scoundrel"), (None, None), (7, rows[7][1]), (7, rows[7][1]), (907, "vile scoundrel " * 20_000)]
    d = spark.createDataFrame([(i, t, 1.0, "w") for i, t in rows + odd], "doc_id long, text string, severity double, words string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.severity(d, labels).collect()
    assert len(got) == 205 and sum(r.doc_id is None and r.toxic for r in got) == 1
    sevens = [(r.severity, r.toxic) for r in got if r.doc_id == 7]
    assert len(sevens) == 3 and set(sevens) == {(sevens[0][0], False)} and [r.toxic for r in got if r.doc_id == 907] == [True]


def test_quality_posteriors_by_hand(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(BASE[i % 9: i % 9 + 12]) if rng.random() < 0.7 else "### $$ " * 12, "en" if i % 2 else None, f"s{int(i % 7 > 4)}")
            for i in range(160)] + [(1, "words of another text", "en", "s0"), (None, None, "fr", None), (900, "x " * 30_000, "en", "s9")]
    d = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, source string, host double")
    labels = spark.createDataFrame([(i, int(not t.startswith("#"))) for i, t, _, _ in rows[:100]], "doc_id long, quality int")
    got = quality.classify(d, labels).collect()
    assert len(got) == len(rows)
    rate = (sum(not t.startswith("#") for _, t, _, _ in rows[:100]) + 1) / 102
    good = {id(r): 1 / (1 + math.exp(-(r.log_odds + math.log(rate / (1 - rate))))) for r in got}

    def group(key):
        out = {}
        for r in got:
            s, n = out.get(key(r), (0.0, 0))
            out[key(r)] = s + good[id(r)], n + 1
        return out
    hosts, sites = group(lambda r: r.host), group(lambda r: (r.host, r.path))
    mean, strength = quality.prior_moments(sum(s for s, _ in hosts.values()), float(len(got)), len(hosts),
                                           sum(s * s / n for s, n in hosts.values()), float(sum(n * n for _, n in hosts.values())))
    spread = noise = free = size = 0.0
    for h, (s, n) in hosts.items():
        inside = [v for (x, _), v in sites.items() if x == h]
        spread += sum(a * a / b for a, b in inside) - s * s / n
        noise += (len(inside) - 1) * (s / n) * (1 - s / n)
        free += len(inside) - 1
        size += n - sum(b * b for _, b in inside) / n
    between = (spread - noise) / size
    own = min(max(noise / free / between - 1, 1.0), 1e6) if between > 0 else 1e6
    for r in got:
        s, n = hosts[r.host]
        host = (s + mean * strength) / (n + strength)
        s, n = sites[r.host, r.path]
        site = min(max((s - good[id(r)] + host * own) / (n - 1 + own), 1e-6), 1 - 1e-6)
        odds = r.log_odds + math.log(site / (1 - site))
        assert (r.host_rate, r.site_rate) == (pytest.approx(host), pytest.approx(site))
        assert r.quality == pytest.approx(1 / (1 + math.exp(-odds))) and r.keep == (r.quality >= quality.KEEP)


def test_an_id_that_repeats_adds_one_text_to_the_sample(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(2, "other")]
    ids = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, y int")
    from martlake.llm.labelled import one_text_each
    assert one_text_each(spark.createDataFrame(rows, "doc_id long, text string"), ids).count() == 2


# --- near duplicates, and the pipeline ------------------------------------------

def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def kept_by_hand(rows, n=5, percent=80):
    """Rows (position, id, text) that stay: one of each component of sets."""
    sets = []
    for _, _, t in rows:
        w = words(t)
        sets.append({tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                comp[root(a)] = root(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    bare = {i for i in range(len(rows)) if not sets[i]}
    return [g for r, g in groups.items() if not bare & set(g)], bare


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    near = " ".join(BASE[:-1] + ["mountains"])
    given = [(1, " ".join(BASE)), (2, near), (2, "a text of its own under a repeated id"), (2, "a text of its own under a repeated id"),
             (None, " ".join(BASE)), (None, "only rows without an id say this here"), (None, "only rows without an id say this here"),
             (None, None), (3, ""), (4, None), (5, "short"), (6, "Short"), (7, "lone words " * 40), (1, "the first id says another thing too")]
    df = spark.createDataFrame([(i, t, f"r{k}", "c") for k, (i, t) in enumerate(given)], "doc_id long, text string, row string, cls string")
    got = sorted(int(r.row[1:]) for r in jaccard.keep_one(df.repartition(3)).collect())
    groups, bare = kept_by_hand([(k, i, t) for k, (i, t) in enumerate(given)])
    assert bare <= set(got) and len(got) == len(groups) + len(bare)
    for g in groups:
        (stays,) = set(g) & set(got)
        least = min((given[k][0] is None, given[k][0] or 0) for k in g)
        assert (given[stays][0] is None, given[stays][0] or 0) == least
    again = sorted(int(r.row[1:]) for r in jaccard.keep_one(df.repartition(5)).collect())
    assert again == got
    assert jaccard.keep_one(df.limit(0)).count() == 0 and jaccard.keep_one(df).columns == df.columns


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    item = " ".join(BASE[i * 7 % len(BASE)] for i in range(26))
    rnd = np.random.default_rng(11)
    rows = []
    for i in range(220):
        w = [BASE[int(x)] for x in rnd.integers(0, len(BASE), 60)]
        rows.append((i, " ".join(w), "en", f"s{i % 3}"))
    rows += [(300 + i, "### $$$ !!! 999 " * 30 + str(i), "en", "s0") for i in range(40)]  # junk
    rows += [(400, rows[3][1], "en", "s1"), (401, rows[3][1] + " tail", "en", "s1"), (402, rows[7][1] + " start " + item + " " + rows[8][1], "en", "s2"),
             (403, None, "en", "s1"), (404, "", None, None), (405, "12 34 56 " * 9, "en", "s1"), (5, rows[9][1] + " " + rows[10][1], "en", "s1"),
             (None, rows[3][1], "en", "s1"), (None, " ".join(reversed(BASE)), "en", "s1")]
    docs = [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300), 0) for i in list(range(0, 220, 2)) + list(range(300, 340, 2))],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_against_its_stages_by_hand(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{small_tables}/{t}.parquet") for t in ("labels", "benchmark"))

    def rows_of(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    keep = Counter((r.doc_id, r.fp) for r in quality.classify(docs, labels).where("keep").collect())
    good = docs.withColumn("fp", F.xxhash64("text")).collect()
    one = [r for r in good if keep[r.doc_id, r.fp]]
    assert 200 < len(one) < 240 and not any(300 <= (r.doc_id or 0) < 340 for r in one)
    frame = spark.createDataFrame(one, "doc_id long, text string, lang string, source string, n_chars long, fp long").drop("fp")
    spoken = rows_of(langid.keep_language(frame))
    assert all(re.search("[a-z]", t or "") for _, t in spoken) and {i for i, _ in spoken} >= set(range(220))
    groups, _ = kept_by_hand([(k, i, t) for k, (i, t) in enumerate(spoken)])
    single = []
    for g in groups:
        best = min(g, key=lambda k: (spoken[k][0] is None, spoken[k][0] or 0))
        tied = [k for k in g if spoken[k][0] == spoken[best][0] and spoken[k][1] != spoken[best][1]]
        assert not tied  # in these rows the id decides
        single.append(spoken[best])
    marked = {(r.doc_id, r.fp) for r in decontam.contamination(docs, bench).where("contaminated").collect()}
    prints = {(r.doc_id, r.text): r.fp for r in good}
    clean = [r for r in single if (r[0], prints[r]) not in marked]
    assert len(clean) < len(single) and 402 not in {i for i, _ in clean}
    got = corpus_pipeline.run(spark, small_tables).collect()
    want = Counter()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    for i, t in clean:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            want[i, k, s, len(ids[s: s + 2048]), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s: s + 2048]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert {1, 5} <= {r.doc_id for r in got} and packing.CAPACITY == 2048 and hashlib.md5(b"").digest()


def test_pipeline_stages_of_empty_tables(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small_tables).count() == 0


def test_looked_up_gives_each_key_its_value():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 500, np.uint64) * np.uint64(2) + np.uint64(1))
    value = rng.random(len(keys)).astype(np.float32)
    at = rng.integers(0, len(keys), 3000)
    assert (lm._looked_up(keys[at], keys, value) == value[at].astype(float)).all()
    assert (lm._radix_order(keys[at]) == np.argsort(keys[at], kind="stable")).all()
    assert len(lm._looked_up(keys[:0], keys, value)) == 0


def test_units_are_remembered_in_arrays_and_learned_once():
    encoder = packing.ChunkEncoder(tokenizer_path())
    text = "Well-known  words, don't 12ab café 漢字 zyxwvq".encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    first = encoder.encode(data, off)[0].tolist()
    known = len(encoder.slot)
    again = encoder.encode(data, off)[0].tolist()
    assert first == again == [*encoder.plain.encode(text.decode(), add_special_tokens=False).ids, 0]
    assert encoder.begin.dtype == encoder.count.dtype == np.int64 and len(encoder.pool) == encoder.count.sum()
    assert len(encoder.slot) == known == len(encoder.begin) - 1 == len(encoder.count) - 1
