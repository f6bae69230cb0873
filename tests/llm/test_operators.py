"""The operators against brute force, exact round trips and odd rows."""

import base64
import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from tidemark.llm import bpe, decontaminate, exact_dedup, line_dedup, minhash, quality, sharding, token_files, toxicity, warc
from tidemark.llm.components import connected_components
from tidemark.llm.queries import tokenizer
from tidemark.llm.wand import BlockMaxIndex, BlockMaxMatrix

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, row string, value string"
LONG = "long word " * 20_000
BASE = " ".join(f"word{k}" for k in range(60))
NEAR = BASE.replace("word59", "other")
ROWS = [(1, BASE), (2, BASE), (3, NEAR), (4, None), (5, ""), (6, " \t\n"), (7, "one two"), (8, "ONE  two"), (None, "null id line here\nx"), (9, "null id line here\ny"), (10, LONG), (10, LONG), (11, "a<|endoftext|>b, it's\n\n  Größe 中文 ÀÉ"), (-3, "same line of text\nsame line of text\nown"), (12, " Same LINE of text\t\nelse")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_equals_the_library(name):
    path = tokenizer(name)
    library = Tokenizer.from_file(path)
    vocabulary = bpe.Vocabulary(json.load(open(path)))
    assert vocabulary.lookahead > 0
    usual, small, decoder = bpe.Encoder(vocabulary), bpe.Encoder(vocabulary, window=8, block=37), bpe.Decoder(vocabulary)
    rng = random.Random(3)
    signs = ["a", "b", "é", "é", " ", "  ", "\n", "'", "'s", "'re", "!", "1", "中", "Σ", "İ", "<|endoftext|>", "the", "가", " ", "\x1c", "🙂", "x" * 50]
    texts = ["", "ab" * 2000, "!" * 3000, " " * 900 + "x", "中文" * 900, *("".join(rng.choices(signs, k=rng.randint(1, 50))) for _ in range(400))]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(usual.encode(text), "<u4").tolist() == ids
        assert np.frombuffer(small.encode(text), "<u4").tolist() == ids
        assert decoder.decode(np.array(ids, "<u4").tobytes(), 3) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_of_long_runs(name):
    """Runs without a cut, beyond a block: equal to the library, in time that grows as the text does."""
    path, rng = tokenizer(name), random.Random(6)
    library, encoder = Tokenizer.from_file(path), bpe.Encoder(bpe.Vocabulary(json.load(open(path))))
    signs = ["x", "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x4E00, 0x5A00))), "+/09azAZ", "é\u0301a", "!"]
    texts = ["".join(rng.choices(s, k=70_000)) for s in signs] + ["".join(rng.choices(signs[1], k=1_000_000)), "end " + "y" * 66_000 + " after it"]
    for text in texts:
        start = time.process_time()
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert time.process_time() - start < 3 + len(text) / 20_000
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_lookahead_of_small_merge_lists():
    assert bpe.sufficient_lookahead([("a", "b")], len) == 1
    # b joins c before a joins b, and c joins d before that: a chain of three.
    assert bpe.sufficient_lookahead([("c", "d"), ("b", "c"), ("a", "b")], len) == 3
    assert bpe.sufficient_lookahead([("ab", "c"), ("a", "b")], len) is None


def test_bpe_rows(docs, empty):
    path = tokenizer("byte_bpe_50k.json")
    rows = bpe.encode_texts(docs, path, decode=True).collect()
    assert Counter(r.decoded for r in rows) == Counter(t or "" for _, t in ROWS)
    assert bpe.encode_texts(empty, path).count() == 0
    assert {r.decoded for r in bpe.decode_ids(bpe.encode_texts(docs, path), path).collect()} == {t or "" for _, t in ROWS}


def test_wand_is_exact():
    rng = random.Random(1)
    postings = [(d, t, round(rng.random(), 2)) for d in range(300) for t in rng.sample(range(40), 6)]
    index, matrix = BlockMaxIndex(postings, block=8), BlockMaxMatrix(postings, 45, 300, block=4)
    for _ in range(50):
        query = {t: rng.choice([0.5, 1.0, 2.0]) for t in rng.sample(range(45), 7)}
        scores = defaultdict(float)
        for d, t, x in postings:
            if t in query:
                scores[d] += query[t] * x
        assert [d for d, _ in index.above(query, 1.5)] == sorted(d for d, s in scores.items() if s >= 1.5)
        best = sorted(((-s, d) for d, s in scores.items() if s > 0))[:5]
        assert [round(s, 9) for _, s in index.nearest(query, 5)] == [round(-s, 9) for s, _ in best]
        by_matrix = matrix.nearest(query, 5)
        assert [round(s, 9) for _, s in by_matrix] == [round(-s, 9) for s, _ in best]
        assert all(abs(scores[d] - s) < 1e-9 for d, s in by_matrix)


def test_leaks(spark, docs, empty):
    rng = random.Random(2)
    common, rare = [f"c{k}" for k in range(30)], [f"r{k}" for k in range(4000)]
    items = [(i, " ".join(rng.choices(common, k=8) + rng.sample(rare, 20)) + ". The answer is " + " ".join(rng.sample(rare, 3)) + ".") for i in range(30)] + [(30, None), (31, " ... "), (None, "short")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = [(100 + k, " ".join(rng.choices(common, k=150) + rng.sample(rare, 60))) for k in range(30)]
    dirty = [(200 + k, " ".join(rng.choices(common, k=97 * k % 300)) + " " + items[k][1].upper() + " tail " * (k % 40)) for k in range(30)]
    found = decontaminate.find_leaks(frame(spark, clean + dirty), bench, max_index_bytes=3000)
    got = {(r.row.doc_id, x.item_id) for r in found.collect() for x in r.leaks}
    assert got == {(200 + k, k) for k in range(30)}
    assert decontaminate.find_leaks(docs, bench).count() == len(ROWS)
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == len(ROWS)
    assert decontaminate.find_leaks(empty, bench).count() == 0


def test_toxicity(spark, docs, empty):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        rows.append((k, " ".join(rng.choices(words, k=40) + rng.choices(["vile", "nasty", "awful"], k=3) * toxic)))
        labels.append((k, int(toxic)))
    frames = frame(spark, rows + [(5000, None), (5001, "")]), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(*frames)
    scored = toxicity.score_toxicity(frames[0], model).select("row.doc_id", "score", toxicity.held_out("row.doc_id").alias("held_out"), "evidence").collect()
    held = [r for r in scored if r.held_out and r.doc_id < 900]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in scored)
    assert all((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in held)
    assert all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id >= 5000}) == 1
    assert toxicity.score_toxicity(empty, model).count() == 0
    nothing = toxicity.fit_toxicity(docs, frames[1].limit(0))
    assert {r.score for r in toxicity.score_toxicity(docs, nothing).collect()} == {0.0}


def _components(rows, width, percent):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
        sets.setdefault(doc, []).append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        p, q = sorted((find(a), find(b)))
                        root[q] = p
    return {d: find(d) for d in sets}


def test_near_duplicates_equal_brute_force(spark, empty, monkeypatch):
    rng = random.Random(6)
    base = [f"v{k}" for k in range(60)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"n{rng.randrange(500)}"
        rows.append((k, " ".join(words)))
    rows += [(100 + i, t) for i, (_, t) in enumerate(ROWS)] + [(200 + k, " ".join(rng.choices(base, k=5))) for k in range(40)]
    want = _components(rows, 4, 80)
    got = minhash.near_duplicates(frame(spark, rows), width=4).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    # Blocks so small that buckets and clusters are split.
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", 7)
    monkeypatch.setattr(minhash, "SET_BLOCK", 600)
    monkeypatch.setattr(minhash, "NODE_BLOCK", 9)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), width=4).collect()} == want
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_odd_rows(docs):
    got = [tuple(r) for r in minhash.near_duplicates(docs, width=4).collect()]
    assert len(got) == len(ROWS)
    by = {r[0]: r for r in got}
    assert by[2][2] == by[3][2] == 1 and by[8][2] == 7 and by[4][1] == 0 and by[4][2] == 4 and by[None][2] is None


def test_estimate_without_chance():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    least = np.stack([minhash.minima(values[:1000]), minhash.minima(values[250:1250]), minhash.minima(values[1000:])])
    signs = minhash.packed(least)
    assert signs.shape == (3, minhash.HASHES * minhash.BITS // 64)
    assert minhash.estimate(signs[0], signs[0]) == 1
    assert abs(minhash.estimate(signs[0], signs[1]) - 0.6) < 0.15
    assert abs(minhash.estimate(signs[0], signs[2])) < 0.15


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(1000, 1040)] + [(3000, k) for k in range(3001, 3100)]
    root = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: c for n, c in root.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_quality(spark, docs, empty):
    rng = random.Random(7)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        grade = k % 4
        rows.append((k, " ".join(w + "$$" * (rng.random() > grade / 3) for w in rng.choices(words, k=60))))
        labels.append((k, grade))
    both = frame(spark, rows), spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id bigint, quality int")
    model = quality.fit_quality(both[0], both[1].where("doc_id < 300 or doc_id is null"))
    assert list(model.thresholds) == sorted(model.thresholds) and model.grades == [0, 1, 2, 3]
    scored = quality.score_quality(both[0], model, at_least=2).where("row.doc_id >= 300").collect()
    assert np.mean([abs(r.expected_grade - r.row.doc_id % 4) < 0.75 for r in scored]) > 0.9
    assert np.mean([r.kept == (r.row.doc_id % 4 >= 2) for r in scored]) > 0.9
    assert quality.score_quality(empty, model).count() == 0
    unfitted = quality.fit_quality(docs, both[1].limit(0))
    assert all(r.kept for r in quality.score_quality(docs, unfitted).collect())


PAGES = [(1, "http://a/ä b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (5, "u", "ü" * 50_000), (None, "u", "only"), (6, "u", "last")]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id bigint, url string, html string, payload string, record_type string")
    files = warc.write_archives(pages.coalesce(2), str(tmp_path / "w"))
    got = {r.page_id: r for r in warc.read_archives(spark, files, strict=True).withColumn("page_id", warc.key_of("record_id")).withColumn("to", warc.key_of("refers_to")).collect()}
    assert len(got) == len(PAGES)
    for key, _, html in PAGES:
        data = (html or "").encode()
        assert got[key].payload_bytes == len(data) and got[key].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[key].record_type == ("revisit" if key in (1, 3) else "response")
        assert got[key].to == {1: 2, 3: 4}.get(key)
        assert got[key].payload == (None if key in (1, 3) else data)
    none = warc.write_archives(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, none).count() == 0


def test_warc_dictionary_and_damage(tmp_path):
    from tidemark.llm.tasks import Upload

    rng = random.Random(1)
    payloads = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "<p>", "</p>"], k=200)).encode() for _ in range(60)]
    writer = warc.ArchiveWriter(Upload(str(tmp_path), "x.warc.zst"), payloads)
    for k, data in enumerate(payloads):
        writer.page(k, "u", data, warc.digest_of(data), None, False)
    writer.add([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:99>")], b"")
    writer.upload.commit()
    raw = (tmp_path / "x.warc.zst").read_bytes()
    assert raw[:4] == warc.SKIPPABLE.to_bytes(4, "little")
    import io

    records = list(warc.ArchiveReader(io.BytesIO(raw)).records())
    assert [r[3] for r in records[:60]] == [None] * 60 and records[60][3] == "no warc-date header"
    assert [warc.http_parts(h, b)[1] for _, h, b, _ in records[:60]] == payloads
    cut = list(warc.ArchiveReader(io.BytesIO(raw[: len(raw) // 2])).records())
    assert cut[-1][3] == "archive ends inside a frame" and all(r[3] is None for r in cut[:-1])
    bad = zstandard.ZstdCompressor().compress(b"WARC/1.1\r\nWARC-Type: x\r\nWARC-Record-ID: y\r\nWARC-Date: z\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    assert "length" in list(warc.ArchiveReader(io.BytesIO(bad)).records())[0][3]


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype("<u4")
    data = token_files.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (token_files.unpack(data, 1001, bits) == ids).all()
    if bits < 32:
        with pytest.raises(ValueError):
            token_files.pack(np.array([1 << bits], "<u4"), bits)


def test_token_files(spark, docs, empty, tmp_path):
    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for block in (64, 4096):
        folder = str(tmp_path / f"t{block}")
        files = token_files.write_token_files(docs, path, folder, block=block)
        rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
        ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        assert [r.doc_id for r in rows] == [i for i, _ in ordered]
        place = 0
        for row, (_, text) in zip(rows, ordered):
            want = library.encode(text or "", add_special_tokens=False).ids + [0]
            assert row.start == place and row.n_tokens == len(want) and np.frombuffer(row.ids, "<u4").tolist() == want
            place += len(want)
        file = token_files.TokenFile(files.orderBy("part").first().file)
        whole = file.read(0, file.ids)
        for _ in range(20):
            a = random.randrange(file.ids)
            n = random.randrange(min(500, file.ids - a) + 1)
            assert (file.read(a, n) == whole[a : a + n]).all()
    token_files.write_token_files(empty, path, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def _kept_lines(rows, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        own = float("inf") if doc is None else doc
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) > 1 and own != min(holders[key(x)]))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (5, 2), (7, 3)])
def test_line_dedup(spark, docs, empty, batches, fan_in):
    rng = random.Random(batches)
    lines = ["  Header of PAGE ", "header of page", "short", "Ünique line %d", "footer: all rights", ""]
    rows = ROWS + [(20 + k, "\n".join(rng.choice(lines).replace("%d", str(rng.randrange(9))) for _ in range(rng.randrange(8)))) for k in range(60)]
    got = line_dedup.drop_repeated_lines(frame(spark, rows), batches=batches, fan_in=fan_in).collect()
    assert sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got), key=repr) == _kept_lines(rows)
    assert line_dedup.drop_repeated_lines(empty, batches=batches).count() == 0


def test_line_dedup_of_a_third_without_identifier(spark):
    """Null identifiers are one document; what a row loses is bounded by its own lines, not by that document's."""
    own = [[f"common line number {k % 5}", f"a line of row {k} alone", f"shared by two rows {k // 2}"] for k in range(60)]
    rows = [(None if k % 3 == 0 else k, "\n".join(lines)) for k, lines in enumerate(own)]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string")
    holders = {}
    for number, text in rows:
        for line in text.split("\n"):
            holders.setdefault(line, set()).add(line_dedup.LAST_ID if number is None else number)
    want = sorted("\n".join(x for x in text.split("\n") if len(holders[x]) < 2 or min(holders[x]) == (line_dedup.LAST_ID if number is None else number)) for number, text in [*rows, rows[0]])
    for batches in (1, 3):
        assert sorted(r.kept_text for r in line_dedup.drop_repeated_lines(df, batches=batches).collect()) == want
        lost = line_dedup.line_owners(df, "doc_id", "text", 10, batches, 2).where(f"id = {line_dedup.LAST_ID}").collect()
        assert len(lost) == 20 and max(len(r.lost) for r in lost) <= 3


def test_exact_dedup_in_many_small_buckets(spark, docs, monkeypatch):
    want = sorted(map(str, exact_dedup.exact_duplicates(docs).collect()))
    monkeypatch.setattr(exact_dedup, "BUCKET_ROWS", 2)
    assert sorted(map(str, exact_dedup.exact_duplicates(docs).collect())) == want


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_dedup(spark, docs, empty, fan_in):
    got = exact_dedup.exact_duplicates(docs.repartition(7), fan_in=fan_in).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[norm(t)].append(i)
    want = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[(i, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_merge_of_runs_compares_lengths():
    run = np.zeros(2, exact_dedup.ENTRY)
    run["size"] = [1, 2]
    with pytest.raises(ValueError):
        exact_dedup.merge_runs([run[:1], run[1:]])


def test_sharding(spark, docs, empty):
    rng = random.Random(5)
    rows = ROWS[:10] + [(1000 + k, "x" * int(rng.paretovariate(1.2) * 50)) for k in range(3000)]
    got = sharding.shard_by_bytes(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    load, places = Counter(), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert max(load.values()) - min(load.values()) < 60 and set(load) == set(range(8))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert len({(r.virtual_slot, r.shard) for r in got}) == len({r.virtual_slot for r in got})
    assert sharding.shard_by_bytes(empty).count() == 0


def test_slot_maps_move_little(spark, tmp_path):
    maps = sharding.SlotMaps(spark, str(tmp_path), 64)
    maps.store(np.arange(64) % 4, 4)
    totals = spark.createDataFrame([(k, 10 + k % 7) for k in range(64)], "virtual_slot int, bytes bigint")
    assert maps.rebalance(totals, 5) == 2
    old, new = maps.array(1), maps.array(2)
    load = np.bincount(new, weights=[10 + k % 7 for k in range(64)], minlength=5)
    assert load.max() - load.min() <= 7 and (old != new).sum() <= 24
