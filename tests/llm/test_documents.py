"""Document operators against brute force, with NULLs, empty and long texts, ties and repeats."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import mixing, near_dup, packing, queries, suffix_dedup, token_file, toxicity
from txnlake.llm.common import arrow_rows
from txnlake.llm.tokens import PieceEncoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, node int, hash int"


def words(seed, n, vocabulary=2000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    arrow_rows(spark, 16)
    passage = words(99, 60)
    long = words(1, 4000)
    near = long.split(" ")
    near[1000:1010] = ["x"] * 10
    texts = [
        (0, None, "a"), (1, "", "a"), (2, " \n\t ", None), (3, "one two", "b"), (4, "one two", "b"),
        (5, long, "b"), (6, long, None), (7, " ".join(near), "c"), (8, "é" * 300 + passage, "c"),
        (9, words(2, 50) + "\n" + passage + " end", "d"), (10, "ab" * 400, "d"), (10, "ab" * 400, "d"),
        (None, words(3, 80), "e"), (11, words(4, 80), ""), (12, words(4, 80) + " tail", "ü"),
        (13, "<|endoftext|> a <|endoftext|>", "a"), (14, "漢字 " * 50 + "\u0301", "a"),
    ]
    rows = [(i, t, "en", s, len(t or ""), "p", 1, 2) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_cut(texts, length):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mask[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((len(b), int(mask.sum()), spans, np.frombuffer(b, np.uint8)[~mask].tobytes()))
    return out


def test_repeated_strings_equal_brute_force(odd_docs):
    texts = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()]
    want = Counter((i, *w) for (i, _), w in zip(texts, brute_cut([b for _, b in texts], 200), strict=True))
    got = suffix_dedup.remove_repeats(odd_docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want


@pytest.mark.parametrize("hot", [2, 5])
def test_hot_anchors_are_divided(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    shared = words(7, 80)
    rows = [(i, words(i, 30) + f" {i} " + shared[i % 7 :] + words(i + 500, 9)) for i in range(12)]
    rows += [(20 + i, f"{i:05d} " + shared[:230] + f" {i:05d}") for i in range(12)]
    rows += [(40 + i, shared[i * 3 : 250 + i]) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_cut([r.text.encode() for r in docs.orderBy("doc_id").collect()], 200)
    got = suffix_dedup.remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == want


def test_no_repeats_in_no_documents(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.deduplicated_documents(no_docs).count() == 0


def test_cut_documents_keep_clean_rows(odd_docs):
    rows = {r.doc_id: r for r in suffix_dedup.deduplicated_documents(odd_docs).collect()}
    assert rows[3].text == rows[4].text == "one two" and rows[0].text == ""
    assert 10 not in rows and 5 not in rows and all(r.n_chars == len(r.text) for r in rows.values())


def brute_classes(rows):
    rows = list(enumerate(rows))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [near_dup.shingles(t or "") for _, (_, t) in rows]
    for i, (_, (_, a)) in enumerate(rows):
        for j in range(i):
            if (a or "") == (rows[j][1][1] or "") or near_dup.prob_jaccard(*sets[i], *sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    groups = {}
    for i, (_, (doc_id, _)) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return Counter((rows[i][1][0], least[find(i)]) for i in range(len(rows)))


def test_near_duplicates_equal_brute_force(spark, odd_docs, no_docs):
    base = words(50, 200).split(" ")
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    for k in range(30):  # a chain of copies, each a little further from the first
        base[k * 6] = f"n{k}"
        rows.append((100 + k, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    got = Counter((r.doc_id, r.class_id) for r in near_dup.near_duplicates(docs).collect())
    assert got == brute_classes(rows)
    assert len({c for d, c in got if d is not None and d >= 100}) < 30
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in got if c is not None})
    assert near_dup.near_duplicates(no_docs).count() == 0 and near_dup.one_of_each(no_docs).count() == 0


def test_pairs_are_verified_on_whole_hashes(spark):
    # Shingles of unlike texts that agree in their upper halves must not count as common.
    low = np.arange(1, 301, dtype=np.uint64)
    a, b = (low << np.uint64(32)) + np.uint64(1), (low << np.uint64(32)) + np.uint64(2)
    pack = lambda h: near_dup._weighted(h.tobytes(), b"")
    assert near_dup.prob_jaccard(*pack(a), *pack(b)) == 0.0
    assert near_dup.prob_jaccard(*pack(a), *pack(a)) == 1.0
    docs = spark.createDataFrame([(1, words(80, 300)), (2, words(80, 300) + " z")], "doc_id long, text string")
    nodes = near_dup._nodes(docs)
    table = near_dup._shingle_table(docs, nodes, near_dup._buckets(nodes)).collect()
    texts = {len(near_dup.shingles(t)[0]): near_dup.shingles(t) for t in (r.text for r in docs.collect())}
    assert len(table) == 2
    for row in table:
        hashes, counts = near_dup._weighted(row.hashes, row.counts)
        want = texts[len(hashes)]
        assert (hashes == want[0]).all() and (counts == want[1]).all()


def test_blocks_of_several_rows_and_columns(spark, monkeypatch):
    # A small BLOCK spreads each open bucket over many blocks; no link may be lost.
    monkeypatch.setattr(near_dup, "BLOCK", 2)
    base, rows = words(60, 200).split(" "), []
    for k in range(40):
        base[k * 5] = f"n{k}"
        rows.append((k, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id) for r in near_dup.near_duplicates(docs).collect())
    assert got == brute_classes(rows)


def test_near_duplicates_without_or_with_repeated_ids(spark):
    def near(seed, k):
        return " ".join([*words(seed, 200).split(" ")[: 200 - k], *(f"y{i}" for i in range(k))])

    rows = [
        (None, near(70, 0)), (None, near(70, 0)), (7, near(70, 2)),  # NULL ids near to a named text
        (None, near(71, 0)), (None, near(71, 2)), (None, near(71, 2)),  # NULL ids only
        (5, near(72, 0)), (5, near(73, 0)), (6, near(72, 2)), (4, near(73, 2)),  # one id, two texts
        (8, near(74, 0)), (8, near(75, 0)), (8, near(75, 0)),  # one id names two classes
        (None, near(75, 0)), (9, None), (9, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    got = near_dup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == brute_classes(rows)
    assert sorted(Counter(r.class_text for r in got).values()) == [1, 2, 2, 2, 3, 3, 3]
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    kept = Counter((r.doc_id, r.text or "") for r in kept.collect())
    nameless = min((near(71, 0), near(71, 2)), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    want = [(7, near(70, 2)), (None, nameless), (5, near(72, 0)), (4, near(73, 2))]
    assert kept == Counter([*want, (8, near(74, 0)), (8, near(75, 0)), (9, "")])


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(5)
    a = np.sort(rng.choice(1 << 30, 300, replace=False)).astype(np.uint64)
    b = np.sort(np.concatenate([a[:260], rng.choice(1 << 31, 40, replace=False).astype(np.uint64)]))
    wa, wb = rng.integers(1, 5, 300), rng.integers(1, 5, len(b))
    da, db = dict(zip(a.tolist(), wa.tolist(), strict=True)), dict(zip(b.tolist(), wb.tolist(), strict=True))
    want = sum(
        1 / sum(max(da.get(e, 0) / da[d], db.get(e, 0) / db[d]) for e in da.keys() | db.keys())
        for d in da.keys() & db.keys()
    )
    exact = near_dup.prob_jaccard(a, wa, b, wb)
    assert exact == pytest.approx(want)
    agree = [
        (near_dup.signature(a ^ np.uint64(k << 40), wa) == near_dup.signature(b ^ np.uint64(k << 40), wb)).mean()
        for k in range(40)
    ]
    assert np.mean(agree) == pytest.approx(exact, abs=0.03)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_the_library_does(name):
    encoder = PieceEncoder(queries.tokenizer_file(name))
    rng = random.Random(3)
    parts = [" ", "\n", "\t", "a", "Bc", "é", "\u0301", ".", "!!", "'s", "12", "\xa0", "\x1c", "<|endoftext|>", "İ,", "漢", "\0", "x,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode_many(texts), strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_file_round_trip(odd_docs, no_docs):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    library = PieceEncoder(path).tokenizer
    rows = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in odd_docs.collect()]
    read = token_file.token_file(odd_docs, path).collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in read) == Counter(
        (i, tuple(ids)) for i, ids in rows
    )
    read.sort(key=lambda r: r.start)
    assert [r.start for r in read] == np.cumsum([0] + [r.n_tokens for r in read])[:-1].tolist()
    assert [r.doc_id for r in read] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert token_file.token_file(no_docs, path).count() == 0


@pytest.mark.parametrize("counts", [{3: 1}, {1: 5, 9: 5}, {i: 2**min(i, 40) for i in range(60)}, {i: 1 for i in range(300)}])
def test_code_lengths_are_a_bounded_prefix_code(counts):
    lengths = token_file.code_lengths(counts)
    assert set(lengths) == set(counts) and max(lengths.values()) <= token_file.MAX_BITS
    assert sum(2.0**-b for b in lengths.values()) <= 1.0
    book = token_file.Codebook(lengths)
    ids = np.array(list(counts) * 700, np.uint16)
    payload, marks = book.encode(ids)
    assert (book.decode(payload, marks, len(ids)) == ids).all()


def test_packing_is_gapless_and_tight(odd_docs, no_docs):
    path, capacity = queries.tokenizer_file("word_bpe_49k.json"), 64
    library = PieceEncoder(path).tokenizer
    want = Counter()
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            own = np.array(ids[k : k + capacity], "<u4").tobytes()
            want[r.doc_id, k // capacity, k, len(own) // 4, zlib.crc32(own)] += 1
    rows = packing.pack_documents(odd_docs, path, capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in bins.values():
        content.sort()
        assert [o for o, _ in content] == np.cumsum([0] + [n for _, n in content])[:-1].tolist()
        assert sum(n for _, n in content) <= capacity
    assert len(bins) <= -(-sum(r.length for r in rows) // capacity) + 2
    assert packing.pack_documents(no_docs, path, capacity).count() == 0


def fewest_bins(sizes, capacity):
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_dominant_sets_never_cost_a_bin():
    rng = random.Random(11)
    for _ in range(150):
        capacity = rng.randrange(4, 14)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randrange(1, 9))), reverse=True)
        counts = np.bincount(sizes, minlength=capacity + 1)
        fixed = packing.dominant_sets(counts)
        rest = sorted(np.repeat(np.arange(capacity + 1), counts).tolist(), reverse=True)
        assert sum(n for _, n in fixed) + fewest_bins(rest, capacity) == fewest_bins(sizes, capacity)


def test_mix_meets_targets_and_repeats(odd_docs, no_docs, spark):
    rows = mixing.mix(odd_docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
        assert r.taken <= 3 * r.size
    targets = mixing.source_targets({r.source: sizes[r.source] for r in rows})
    for source, target in targets.items():
        own = [r for r in rows if r.source == source]
        assert all(r.target == target and r.source_size == sizes[source] for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 3 * mixing.BLOCK_WORDS
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert sorted(map(str, mixing.mix(odd_docs).collect())) == sorted(map(str, rows))
    taken = Counter()
    for r in mixing.mixed_documents(odd_docs).collect():
        taken[r.doc_id] += len(r.text.split())
    want = Counter()
    for r in rows:
        want[r.doc_id] += r.taken
    assert taken == +want
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_permutations_and_shard_draws(n):
    assert sorted(mixing.permute(np.arange(n), n, 12345).tolist()) == list(range(n))
    slots = np.array([n * 50, 0, 7, 20_000])
    shards = -(-int(slots.sum()) // mixing.SHARD_SLOTS)
    drawn = [mixing.shard_counts(s, slots, 3, {}) for s in range(shards)]
    assert (sum(c for c, _ in drawn) == slots).all()
    for k in range(1, shards):
        assert (drawn[k][1] == drawn[k - 1][1] + drawn[k - 1][0]).all()


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng, rows, labels = random.Random(8), [], []
    for i in range(600):
        text, toxic = words(i, 60).split(" "), i % 4 == 0
        if toxic:
            text[10:13] = rng.sample(["sluggard", "nitwit", "dunderhead", "oaf"], 3)
        rows.append((i, " ".join(text), 1))
        labels.append((i, int(toxic)))
    rows += [(9001, None, 1), (9002, "", 1), (9003, "nitwit oaf", 1), (None, "sluggard nitwit", 1), (0, rows[0][1], 1)]
    labels += [(None, 1), (5, None), (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark, toxic_docs):
    docs, labels = toxic_docs
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0.0 <= r.score <= 1.0 for r in rows)
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            if r.doc_id < 600:
                assert r.predicted == int(r.doc_id % 4 == 0)
        else:
            assert r.predicted == 1
    other = {r.doc_id: r.predicted for r in rows if r.doc_id is not None and r.doc_id > 9000}
    assert other == {9001: 0, 9002: 0, 9003: 1}
    clean = toxicity.clean_documents(docs, labels)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted([i for i in range(600) if i % 4] + [9001, 9002])
    nothing = toxicity.score_toxicity(docs, labels.limit(0)).collect()
    assert len(nothing) == docs.count() and {r.predicted for r in nothing} == {0}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_toxicity_sees_whole_texts(spark):
    rng = random.Random(12)
    known = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(known, k=rng.randrange(1, 40)))) for i in range(300)]
    train = [i for i in range(1000, 1010) if zlib.crc32(str(i).encode()) % 5]
    rows += [(i, f"zounds vile knave {'zounds ' * k}") for k, i in enumerate(train[:3])]
    rows += [(2000, rows[301][1]), (2001, "zounds unheardof"), (2002, "unheardof"), (2003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in rows if i < 2000], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert {i for i, r in got.items() if r.predicted} == {*train[:3], 2000, 2001}
    assert got[2002].evidence == got[2003].evidence == [] and got[2002].score < 0.1

    counts = {}
    for i, text in rows:
        counts[i] = Counter(text.split())
        for word, n in list(counts[i].items()):
            for k in (4, 5):
                if len(word) >= k:
                    counts[i][word[:k] + "*"] += n
    df = Counter(t for c in counts.values() for t in c)
    weights = {
        i: {t: (1 + np.log(n)) * (np.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in c.items()}
        for i, c in counts.items()
    }
    norm = {i: np.sqrt(sum(w * w for w in v.values())) for i, v in weights.items()}
    examples = [i for i, _ in rows if i < 2000 and zlib.crc32(str(i).encode()) % 5]
    for i, v in weights.items():
        cosine = {e: sum(w * weights[e].get(t, 0) for t, w in v.items()) / norm[e] for e in examples}
        best = sorted((c for c in cosine.values() if c > 0), reverse=True)[:5]
        assert np.allclose([cosine[e] for e in got[i].evidence], best)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    examples = []
    for i in range(700):
        terms = tuple(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist()))
        examples.append((terms, tuple(rng.integers(1, 4, len(terms)).tolist()), 1, int(i % 3 == 0), i))
    idf = rng.uniform(1, 5, 40)
    index = toxicity.BlockMaxIndex(examples, idf)
    dense = np.zeros((700, 40))
    for row, e in enumerate(sorted(examples)):
        dense[row, list(e[0])] = index.unit(e[0], e[1])
    for e in examples[:60]:
        rows, sims = index.nearest(e[0], e[1], 12)
        scores = dense @ dense[sorted(examples).index(e)]
        order = np.lexsort((np.arange(700), -scores))
        have = np.cumsum(index.weight.sum(axis=1)[order])
        bar = scores[order[np.searchsorted(have, 12)]]
        want = set(np.flatnonzero((scores >= bar - 1e-12) & (scores > 0)).tolist())
        assert set(rows.tolist()) == want and np.allclose(np.sort(sims), np.sort(scores[list(want)]))


def test_digest_of_kept_bytes(spark):
    data = spark.createDataFrame([(bytearray(b"ab\xc3"),)], "kept binary").select(F.sha2("kept", 256).alias("d")).first()
    assert data.d == hashlib.sha256(b"ab\xc3").hexdigest()
