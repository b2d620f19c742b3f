"""Near-duplicates, decontamination, archives, token files and the classifier on small tables."""

import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from llm_rows import edge_docs, empty_docs, prose, rows, words
from pyspark.sql import functions as F

from sievelake.llm import classifier, components, decontaminate, minhash, repair, storage, text, tokens, warc
from sievelake.llm.queries import tokenizer_path

PAD = ("en", "s", 1) + ("x",) * 12


def found(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ---- near-duplicates


def shingle_sets(table, n):
    out = {}
    for d in table:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1] or "")
        ws = re.findall(r"[^\x20\x09-\x0D]+", lower)
        own = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())
        out.setdefault(d[0], []).append(own)
    return out


def groups_brute(table, n, over, under):
    sets = [(i, s) for i, many in shingle_sets(table, n).items() for s in many if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if a and b and under * common >= over * (len(a) + len(b) - common):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def mutated(rng, ws, share):
    return " ".join(rng.choice(["other", "word", "here"]) if rng.random() < share else w for w in ws)


@pytest.mark.parametrize("shingle,percent", [(3, (85, 100)), (5, (80, 100))])
def test_near_duplicates_are_the_brute_force_groups(spark, shingle, percent):
    """Families of different texts of all degrees of likeness, among them a large one: many bands, few true links."""
    rng = random.Random(shingle)
    more = []
    for family in range(12):
        ws = words(rng, rng.randint(20, 150))
        for i in range(60 if family == 0 else 6):
            more.append((1000 + 100 * family + i, mutated(rng, ws, rng.choice([0, 0.005, 0.01, 0.02, 0.04])), *PAD))
    table = rows() + more
    got = minhash.near_duplicates(edge_docs(spark, more), shingle, percent)
    sets, want = shingle_sets(table, shingle), groups_brute(table, shingle, *percent)
    out = found(got, "doc_id", "n_shingles", "component_id", "kept")
    assert len(out) == len(table)
    for doc_id, n, component, kept in out:
        assert n in {len(s) for s in sets[doc_id]}
        if doc_id is not None:
            assert component == want[doc_id] and kept == (component == doc_id)
    nameless = {(n, component, kept) for doc_id, n, component, kept in out if doc_id is None}
    assert nameless == {(0, None, True), (len(sets[2][0]), 2, False)}


def test_blocks_of_one_family_run_in_many_tasks(spark, monkeypatch):
    """Two thirds of a family lie outside its largest component; no task gets more than a block's rows at once."""
    from pyspark import TaskContext

    def seen(*_):
        import pyarrow as pa

        return lambda table: pa.table({"a": [TaskContext.get().partitionId()], "b": [table.num_rows]}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    for name, value in (("REST_ROWS", 20), ("ALL_ROWS", 40)):
        monkeypatch.setattr(minhash, name, value)
    sets = spark.createDataFrame([(i, bytearray(np.arange(50, dtype=np.uint64).tobytes())) for i in range(600)], "doc_id long, shingles binary")
    labels = spark.createDataFrame([(i, 0, i % 3 if i < 590 else 0) for i in range(600)], "node long, family long, component long")
    real = sorted(map(tuple, minhash._within_families(sets, labels, 80, 100).collect()))
    monkeypatch.setattr(minhash, "_block_links", seen)
    options = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        rows = minhash._within_families(sets, labels, 80, 100).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({r["a"] for r in rows}) > 8 and max(r["b"] for r in rows) < 150
    assert real and all(a % 3 != b % 3 or max(a, b) >= 590 for a, b in real)


def test_bands_of_many_families_are_dealt_in_parts(spark, monkeypatch):
    rng, more = random.Random(4), []
    ws = words(rng, 80)
    more = [(5000 + i, mutated(rng, ws, 0.03), *PAD) for i in range(40)]
    want = dict(found(minhash.near_duplicates(edge_docs(spark, more)), "doc_id", "component_id"))
    monkeypatch.setattr(minhash, "BAND_ROWS", 2)
    assert dict(found(minhash.near_duplicates(edge_docs(spark, more)), "doc_id", "component_id")) == want


def test_near_duplicate_edges(spark):
    docs = edge_docs(spark)
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 20 not in ids and 1 in ids and ids.count(25) == 2 and ids.count(None) == 2 and {22, 23, 24} <= set(ids)
    assert minhash.near_duplicates(empty_docs(spark)).count() == 0
    assert minhash.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    table = minhash._table()
    slices = np.lib.stride_tricks.sliding_window_view(table, minhash.BANDS * minhash.ROWS)
    ratios = []
    for _ in range(40):
        both = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = minhash.signature(both[:270], slices), minhash.signature(both[30:], slices)
        ratios.append((a == b).mean())
    assert np.mean(ratios) == pytest.approx(0.8, abs=0.03)
    # coordinate k is the minimum of the table shifted by k
    one = np.array([12345], np.uint64)
    place = int((text.mix(one ^ np.uint64(minhash.SEED)) >> np.uint64(44))[0])
    assert list(minhash.signature(one, slices)) == [table[(place + k) % (1 << 20)] for k in range(96)]


def test_shingles_are_those_of_plain_python():
    many = ["Aa  b\tc\x0bd É\n", "", "x", "aA B c D É", "a b", " ", "a  B"]
    sets = text.Words([t.encode() for t in many]).shingles(3)
    assert [len(s) for s in sets] == [3, 0, 1, 3, 1, 0, 1]
    assert set(sets[0]) == set(sets[3]) and set(sets[4]) == set(sets[6]) and not set(sets[2]) & set(sets[4])


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200 + i) for i in range(50)] + [(300, 299), (7, 7)]
    got = dict(found(components.components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {i: 1 for i in range(1, 61)} | {100: 100} | {200 + i: 100 for i in range(50)} | {299: 299, 300: 299}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- decontamination


def distance_brute(item, whole):
    before = [0] * (len(whole) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(whole, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


def test_decontamination_is_the_brute_force_one(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(8, 25))) for i in range(8)] + [(50, None), (51, " "), (52, "tiny"), (None, prose(rng, 9)), (9, None)]
    items += [(60, items[0][1])]
    more = []
    for i in range(40):
        item = list(items[i % 8][1])
        for _ in range(rng.randint(0, 10)):
            k = rng.randrange(len(item))
            item[k : k + rng.randint(0, 2)] = rng.choice(["", "q", "zz", "\n ", "W"])
        more.append((2000 + i, prose(rng, 15) + " " + "".join(item) + " " + prose(rng, 15), *PAD))
    table = [r for r in rows() if len(r[1] or "") < 5000] + more
    docs = spark.createDataFrame(table, edge_docs(spark).schema)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d in table:
        whole = decontaminate.normal(d[1])
        for item_id, item in items:
            plain = decontaminate.normal(item)
            if plain and item_id != 60:
                budget, distance = int(len(plain) * 0.05), distance_brute(plain, whole)
                if distance <= budget:
                    want.add((d[0], item_id, distance))
    for block_chars in (1_000_000, 300):
        got = decontaminate.contaminated(docs, benchmark, block_chars=block_chars)
        assert set(found(got, "doc_id", "item_id", "distance")) == want
    left = decontaminate.drop_contaminated(docs, benchmark)
    gone = {w[0] for w in want}
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(d[0] for d in table if d[0] not in gone)
    assert gone and len(gone) < 40


def test_decontamination_edges(spark):
    benchmark = spark.createDataFrame([(1, "a needle of a few words")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    docs = edge_docs(spark, [(1, "a needle of  A few\nwords " * 3000, *PAD)])
    assert found(decontaminate.contaminated(docs, benchmark), "doc_id", "item_id", "distance") == [(1, 1, 0)]
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    assert decontaminate.contaminated(empty_docs(spark), benchmark).count() == 0


# ---- archives

PAGES = "page_id long, url string, html string, frame int, refers_to long"


def pages(spark):
    rng = random.Random(7)
    table = [(i, f"http://x/{i}", f"<p>{prose(rng, 30)}</p>", 0, 0) for i in range(30)]
    table += [(100 + i, "http://y/\r\nX: 1", table[3][2], 0, 0) for i in range(20)]
    table += [(5, table[5][1], table[5][2], 0, 0), (None, None, table[4][2], 0, 0), (None, "u", "alone é", 0, 0)]
    table += [(200, "u", None, 0, 0), (201, None, "", 0, 0), (202, "u", "long " * 100_000, 0, 0)]
    return table, spark.createDataFrame(table, PAGES).repartition(3)


def test_archives_round_trip(spark):
    table, df = pages(spark)
    got = Counter(found(warc.round_trip(df, frame_bytes=4000, bundle_bytes=6000), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    first = {}
    for page_id, _, html, *_ in table:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    want = Counter()
    for page_id, _, html, *_ in table:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers_to = first.get(html or "")
        refers_to = None if refers_to == page_id else refers_to
        want[page_id, len(payload), digest, "response" if refers_to is None else "revisit", refers_to] += 1
    assert got == want
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_small_payloads_may_be_written_again(spark):
    _, df = pages(spark)
    kinds = Counter(r["record_type"] for r in warc.round_trip(df, revisit_from=10**9).collect())
    assert set(kinds) == {"response"}


def test_bundles_are_plain_zstandard_and_the_index_finds_records(spark, tmp_path):
    table, df = pages(spark)
    target = str(tmp_path / "bundles")
    index = warc.write_bundles(df, target, frame_bytes=4000, bundle_bytes=6000)
    ids = Counter()
    for file in (tmp_path / "bundles").iterdir():
        data = file.read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert whole == b"".join(warc.read_frame(data, f) for f in warc.frames(data))
        assert len(warc.frames(data)) == len({r["frame"] for r in index.where(F.col("bundle") == file.name).collect()})
        at = 0
        while at < len(whole):
            header, _, at = warc.parse(whole, at)
            ids[header["warc-record-id"]] += 1
    assert ids == Counter(warc.record_id(t[0]) for t in table)
    some = index.where("page_id IN (3, 104, 202)")
    records = dict(found(warc.read_records(spark, target, some), "page_id", "record"))
    assert set(records) == {3, 104, 202}
    header, block, _ = warc.parse(bytes(records[104]))
    assert header["warc-refers-to"] == "<urn:page:3>" and block.endswith(b"\r\n\r\n")
    assert bytes(records[202]).rstrip().endswith(b"long")


# ---- token files


def plain_ids(many):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in many]


ODD = ["don't STOP…. l'été.", "<|endoftext|> A.b<|ENDOFTEXT|>,c", "İstanbul ΣΑΣ. ȩ́!? x̸y", "12,345.6\ta\x0bb\x1c　c\r\nd", "<|startoftext|>a.b", "ﬁ K Å.", "YENİ, ESKİ.", "T̈ H̱ %"]


@pytest.mark.parametrize("by_word", [True, False])
def test_token_files_hold_the_ids_of_the_library(spark, by_word):
    more = [(3000 + i, t, *PAD) for i, t in enumerate(ODD)]
    docs = edge_docs(spark, more).repartition(4)
    got = found(repair.round_trip(docs, tokenizer_path(), by_word, shard_tokens=500), "doc_id", "start", "n_tokens", "ids_crc32")
    table = sorted(rows() + more, key=lambda d: (d[0] is None, d[0] or 0))
    want = [(d[0], ids) for d, ids in zip(table, plain_ids([d[1] for d in table]))]
    crc = Counter((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want)
    assert Counter((d, n, c) for d, _, n, c in got) == crc
    at = 0
    for doc_id, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [d for d, *_ in sorted(got, key=lambda r: r[1])] == [d for d, _ in want]
    assert repair.round_trip(empty_docs(spark), tokenizer_path(), by_word).count() == 0


def test_texts_are_cut_only_where_the_library_keeps_letters_and_marks_apart():
    import pyarrow as pa

    by_word = tokens.Encoder(tokenizer_path(), True)
    assert "İ" in tokens.LETTERS and "İ" not in by_word.cut and "é" in by_word.cut
    every = [f"{begin}{letter}{mark}" for begin in ("", "x", "Ä") for letter in tokens.LETTERS for mark in tokens.MARKS]
    rng = random.Random(6)
    pool = tokens.LETTERS + list("0129'\"-()<>;:@_") + list("\u0301\u0308\u0331\u030aßſµª一\u200d \t\r") + ["İ", " ", "\n"] * 20 + list(tokens.MARKS) * 12
    every += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 30))) for _ in range(6000)]
    every += [".a", None, "a", "!", "", "é", "?b"]  # no cut at the ends of texts
    ids, counts = by_word.encode(pa.array(every), 1)
    want = plain_ids(every)
    assert list(counts) == list(map(len, want)) and list(ids) == [i for w in want for i in w]


def test_a_forgetful_encoder_gives_the_same_ids(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    many = [d[1] for d in rows()[:9]] + ODD
    ids, counts = tokens.Encoder(tokenizer_path(), True).encode(pa.array(many), 1)
    want = plain_ids(many)
    assert list(counts) == list(map(len, want)) and list(ids) == [i for w in want for i in w]


def test_grammar_decodes_any_part_and_shortens():
    rng = np.random.default_rng(3)
    counts = np.array([1, 400, 1, 5000, 3, 2000])
    ids = rng.integers(0, 6, counts.sum()).astype(np.uint32)
    ids[500:2500] = np.tile([7, 7, 7, 8], 500)
    shard = repair.Shard(b"".join(repair._parts([1, None, 3, 4, 5, 6], counts, ids, 10, 0, 0)))
    assert len(shard.rules) > 10 and len(shard.symbols) < len(ids) / 2
    assert (shard.rules < 10 + np.arange(len(shard.rules))[:, None]).all()
    ends = np.cumsum(counts)
    for i, (a, b) in enumerate(zip(ends - counts, ends)):
        assert np.array_equal(shard.ids(i), ids[a:b])
        for _ in range(20):
            first = int(rng.integers(0, b - a))
            n = int(rng.integers(0, 40))
            assert np.array_equal(shard.ids(i, first, n), ids[a + first : min(b, a + first + n)])
    expanded = [repair.Shard.expand(shard, np.array([10 + i])) for i in range(len(shard.rules))]
    assert [len(e) for e in expanded] == list(shard.lengths[10:])
    with pytest.raises(ValueError):
        repair.Shard(b"something else")


def grammar_plain(ids, counts, vocabulary, pairs, least):
    """All pairs counted anew every turn, in plain Python."""
    docs, at, rules = [], 0, []
    for n in counts:
        docs.append([int(x) for x in ids[at : at + n]])
        at += n
    while True:
        seen = Counter(p for d in docs for p in zip(d, d[1:]))
        chosen = sorted(sorted((p for p, n in seen.items() if n >= least), key=lambda p: (-seen[p], p))[:pairs])
        if not chosen:
            return docs, rules
        places = [(i, j) for i, d in enumerate(docs) for j in range(len(d) - 1) if (d[j], d[j + 1]) in set(chosen)]
        taken = set()
        for i, j in places:
            if (i, j - 1) not in taken:
                taken.add((i, j))
        used = [p for p in chosen if any((docs[i][j], docs[i][j + 1]) == p for i, j in taken)]
        number = {p: vocabulary + len(rules) + k for k, p in enumerate(used)}
        rules += used
        docs = [
            [number[d[j], d[j + 1]] if (i, j) in taken else x for j, x in enumerate(d) if (i, j - 1) not in taken]
            for i, d in enumerate(docs)
        ]


def test_grammar_is_that_of_counting_all_pairs_anew():
    rng = np.random.default_rng(8)
    for _ in range(60):
        counts = rng.integers(1, 40, rng.integers(1, 12))
        ids = rng.integers(0, rng.integers(2, 9), counts.sum()).astype(np.uint32)
        pairs, least = int(rng.integers(1, 5)), int(rng.integers(2, 5))
        symbols, each, rules, _ = repair.compress(ids, counts, 20, pairs, least)
        docs, wanted = grammar_plain(ids, counts, 20, pairs, least)
        assert [list(map(int, r)) for r in rules] == [list(r) for r in wanted]
        assert symbols.tolist() == [x for d in docs for x in d] and each.tolist() == list(map(len, docs))


@pytest.mark.parametrize("pairs", [8, repair.PAIRS])
def test_grammar_goes_on_until_no_pair_is_frequent(pairs):
    rng = np.random.default_rng(5)
    counts = np.array([64 * 1000, 300, 1])
    ids = np.concatenate([np.tile(np.arange(64), 1000), rng.integers(0, 40, 301)]).astype(np.uint32)
    symbols, each, rules, lengths = repair.compress(ids, counts, 64, pairs)
    assert each[0] < 64 * 1000 / 1000 and lengths.max() > 32
    ends = set(np.cumsum(each) - 1)
    seen = Counter((a, b) for i, (a, b) in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())) if i not in ends)
    assert max(seen.values()) < repair.LEAST <= 4
    shard = repair.Shard(b"".join(repair._parts([1, 2, 3], counts, ids, 64, 0, 0)))
    assert np.array_equal(np.concatenate([shard.ids(i) for i in range(3)]), ids)


# ---- classifier


def test_classifier_tells_held_out_documents_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = classifier.scored(docs, classifier.train(docs, labels))
    assert out.count() == docs.count()
    held = found(out.join(labels, "doc_id").where("held_out"), "doc_id", "quality", "predicted", "score")
    assert all(zlib.crc32(str(d).encode()) % 3 == 1 for d, *_ in held)
    right = sum(q == p for _, q, p, _ in held)
    assert len(held) > 50 and right >= 0.95 * len(held)
    assert all((s >= 0.5) == p and 0 <= s <= 1 for _, _, p, s in held)


def test_fitting_sees_every_passage(monkeypatch):
    import pyarrow as pa

    text = " ".join(["plain"] * classifier.PASSAGE * 40 + ["#$%"] * classifier.PASSAGE + ["plain"] * classifier.PASSAGE * 59)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([text, ""])], names=["label", "text"])
    (out,) = classifier._featured([batch])
    got = [np.frombuffer(p, np.float32).reshape(-1, classifier.FEATURES) for p in out.column(1).to_pylist()]
    whole, first = classifier.encoded([text.encode()])
    assert [len(x) for x in got] == [100, 1] and np.array_equal(got[0], whole)
    x, first = np.concatenate([got[0], got[1], got[0][35:45]]), np.array([0, 100, 101])
    y, weight = np.array([0.0, 1, 0]), np.ones(3)
    at_once = classifier.fit(x, first, y, weight, 5)
    monkeypatch.setattr(classifier, "PIECE", 8)
    in_pieces = classifier.fit(x, first, y, weight, 5)
    assert all(np.allclose(at_once[k], in_pieces[k]) for k in at_once)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    x, first = rng.normal(size=(7, classifier.FEATURES)), np.array([0, 3, 4])
    y, weight = np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])
    c, g = classifier.CODE, classifier.GATE
    model = {k: rng.normal(0, 0.3, s) for k, s in {"W": (classifier.FEATURES, c), "V": (c, g), "U": (c, g), "w": (g,), "c": (c,), "b": (c,), "d": (1,)}.items()}

    def loss(m):
        p = classifier.forward(m, x, first)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    grad = classifier.gradients(model, x, first, y, weight)
    for k, v in model.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        up, down = ({q: u.copy() for q, u in model.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert grad[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-4, abs=1e-8)


def test_classifier_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(12)] + [(None, 1, "x"), (22, None, "x"), (0, 1, "x")], "doc_id long, quality int, text string")
    model = classifier.train(docs, labels)
    out = found(classifier.scored(docs, model), "doc_id", "held_out", "score", "predicted")
    assert len(out) == docs.count() and all(0 <= s <= 1 for _, _, s, _ in out)
    same = {}
    for row in classifier.scored(docs, model).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert same.setdefault(row["text"] or "", row["score"]) == row["score"]
    good = classifier.keep_good(docs, model)
    assert good.columns == docs.columns and good.count() == sum(p for *_, p in out)
    assert classifier.train(docs, labels.where("quality = 1")) == 1.0
    assert classifier.train(docs, labels.where("false")) == 1.0
    assert classifier.scored(empty_docs(spark), model).count() == 0
    assert classifier.train(empty_docs(spark), labels) == 1.0


def test_files_are_replaced_whole(tmp_path):
    for content in (b"one", b"another"):
        storage.write_file(f"file://{tmp_path}/a b/x%41.bin", [content[:2], content[2:]])
    assert [(p.name, p.read_bytes()) for p in (tmp_path / "a b").iterdir()] == [("x%41.bin", b"another")]
