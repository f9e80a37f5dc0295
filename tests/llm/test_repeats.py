import hashlib
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from penprint.llm import shingles as sh
from penprint.llm import suffix_levels as s
from penprint.llm import weighted_minhash as m
from penprint.llm import winnowing as w
from tests.llm.conftest import prose, rows_of


def brute_removed(rows):
    """{index: bytes that stay} of (doc_id, bytes)."""
    first = {}
    for i, b in rows:
        if i is not None:
            for p in range(len(b) - 49):
                first[b[p : p + 50]] = min(first.get(b[p : p + 50], i), i)
    out = []
    for i, b in rows:
        cut = np.zeros(len(b), bool)
        for p in range(len(b) - 49 if i is not None else 0):
            if first[b[p : p + 50]] < i:
                cut[p : p + 50] = True
        out.append((i, len(b), int(cut.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~cut].tobytes()).hexdigest()))
    return out


def check_removed(docs, batches):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    got = s.remove_repeats(docs, batches=batches).collect()
    found = [(r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), r.kept_sha256) for r in got]
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted(found, key=key) == sorted(brute_removed(rows), key=key)
    for r in got:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert all(x.start < x.end for x in r.removed) and all(x.end < y.start for x, y in zip(r.removed, r.removed[1:]))


def test_repeats_of_hard_texts(hard):
    for batches in (1, 4):
        check_removed(hard, batches)


def test_repeats_at_every_offset(spark):
    """Matches of 49, 50, 51 and more bytes, at the edges of texts and of runs."""
    rng = random.Random(3)
    base = prose(rng, 150)
    texts = [base]
    for n in (49, 50, 51, 60, 83, 84, 85, 120):
        for at in rng.sample(range(len(base) - n), 4):
            texts.append(prose(rng, 5) + "|" + base[at : at + n] + "|" + prose(rng, 5))
            texts.append(base[at : at + n])
    rng.shuffle(texts)
    docs = spark.createDataFrame(rows_of(texts), "doc_id long, text string, source string, lang string, n_chars long, size long, shard int, node string, key long, a string, b string")
    check_removed(docs, 3)


def test_windows_that_share_40_bits_of_a_digest_are_told_apart():
    """Two windows around one anchor, 8 bytes and place of it, with one tail: a second digest tells them apart."""
    rng = np.random.default_rng(2)
    one, other = (s.find_runs(rng.integers(97, 123, 50, dtype=np.uint8), np.array([50])) for _ in range(2))
    other.head, other.tail = one.head, one.tail
    keys = [(r.head, r.tail, r.more) for r in (one, other)]
    assert s._ids(*keys[0])[0] != s._ids(*keys[1])[0]
    order, first = s._grouped(*[np.concatenate(c) for c in zip(*keys)], np.array([1, 2]))
    assert len(first) == 2
    level = [*keys[0], np.array([1], np.uint64), np.array([0], np.uint64)]
    assert s._scanned(list(keys[1]), level)[0] == s._NO_DOC and s._scanned(list(keys[0]), level)[0] == 1


def test_windows_of_a_hot_anchor_are_spread(tmp_path):
    """Different text around one passage: its windows go to all buckets, equal ones to one, and other anchors' runs too."""
    rng = random.Random(4)
    passage = prose(rng, 12)
    texts = [f"{prose(rng, 12)} {passage} {prose(rng, 12)}".encode() for _ in range(300)]
    path = s._write_part(f"file://{tmp_path}", 0, pa.array(range(300)), pa.array(texts, pa.large_binary()))
    head, tail, more, _ = s._read_part(path).entries()
    anchors, counts = np.unique(s._anchors(head, tail), return_counts=True)
    hot = np.flatnonzero(s._anchors(head, tail) == anchors[counts.argmax()])
    assert counts.max() > 100
    rows = [s._row(s.REQUEST, 0, 0, path, s.pack(head[hot], tail[hot], more[hot]))]
    out = s._list_windows(8)(pa.Table.from_pylist(rows, schema=s._ROWS)).to_pylist()
    sizes = [len(s.unpack(r["blob"])[0]) for r in out]
    assert sorted(r["bucket"] for r in out) == list(range(8)) and max(sizes) < sum(sizes) / 4
    keys = [k for r in out for k in zip(*s.unpack(r["blob"])[:3])]
    assert len(keys) == len(set(keys))


def test_levels_merge_geometrically(spark):
    rng = random.Random(1)
    index = s.SuffixLevels(spark, 2)
    sizes = []
    for k in range(5):
        rows = [(10 * k + i, prose(rng, 30).encode()) for i in range(5)]
        index.add(spark.createDataFrame(rows, "doc_id long, text binary"))
        sizes.append([size for size, _, _ in index.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [2, 2, 1]]
    assert index.remove().count() == 25


def test_what_one_part_has_alone_takes_no_entry(spark, tmp_path):
    """Entries and levels hold the runs at anchors of two parts only; what differs inside one part is settled there."""
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage, own = letters(400), letters(300)
    texts = [letters(20_000) for _ in range(12)]
    texts[2], texts[9] = texts[2] + passage, passage + texts[9]
    texts[4], texts[5] = texts[4] + own + "-", own[30:] + "+" + texts[5]
    rows = [(i, t.encode()) for i, t in enumerate(texts)]
    index = s.SuffixLevels(spark, 2)
    index.folder = f"file://{tmp_path}/parts"
    batches = [spark.createDataFrame(rows[a:b], "doc_id long, text binary").coalesce(1) for a, b in ((0, 6), (6, 12))]
    index.add_all(batches)
    entries = [s._read_level(r.path) for _, _, level in index.levels for r in level.collect()]
    assert 20 < sum(len(e[0]) for e in entries) < 200 < sum(len(t) for t in texts) / 100
    folders = [folder for _, folder, _ in index.levels]
    got = index.remove(texts=False, last=True).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), r.kept_sha256) for r in got) == brute_removed(rows)
    assert not any(Path(f.removeprefix("file://")).exists() for f in folders)


def test_short_keys_are_shared_by_parts_alone():
    rng = np.random.default_rng(8)
    one, other, both = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (900, 500, 100))
    parts = [np.concatenate((x, x[:50], both)) for x in (one, other)]
    rows = [r for i, x in enumerate(parts) for r in s._key_rows(i, f"p{i}", s._short(x), 7)]
    assert {r["bucket"] for r in rows} == set(range(7))
    told = [r for b in range(7) for r in s._shared(pa.Table.from_pylist([r for r in rows if r["bucket"] == b], schema=s._ROWS)).to_pylist()]
    for i, x in enumerate(parts):
        assert (s._has_shared(x, [r for r in told if r["part"] == i], 7) == np.isin(x, both)).all()


def test_packing():
    a = np.sort(np.random.default_rng(0).integers(0, 2**63, 500, dtype=np.uint64))
    b, c = a[::-1].copy(), np.arange(500, dtype=np.int64) - 250
    x, y, z = s.unpack(s.pack(a, b, c))
    assert (x == a).all() and (y == b).all() and (z.view(np.int64) == c).all()


def test_no_repeats_in_nothing(empty):
    assert s.remove_repeats(empty).count() == 0


def shingles(text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def test_near_duplicate_classes(hard, hard_texts):
    got = m.near_classes(hard).collect()
    assert len(got) == hard.count()
    bags = {t: shingles(t) for t in {x or "" for x in hard_texts}}
    texts = {r.doc_id: r.text or "" for r in hard.select("doc_id", "text").collect() if r.doc_id is not None}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for i in ids:
        for j in ids:
            a, b = bags[texts[i]], bags[texts[j]]
            union = sum((a | b).values())
            if j < i and (texts[i] == texts[j] or union and sum((a & b).values()) / union >= 0.84):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert {(r.doc_id, r.class_id) for r in got if r.doc_id is not None} == {(i, root(i)) for i in ids}
    kept = m.keep_one(hard)
    assert kept.columns == hard.columns
    rows = kept.select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted({root(i) for i in ids})


def nested_texts():
    """Texts that keep each other apart round by round: lead 0 is unlike all, lead k shares the k first passages with x
    and y, each a single heavy shingle, and x and y list the next one only. x and y are linked to each other only."""
    rng = random.Random(11)

    def value(words):
        return int(sh.shingle_hashes(*sh.word_hashes(pa.array([" ".join(words)])), 5)[0][0]) / 2**64

    def more(words, n):
        """``words`` and so many more, each of which makes a shingle whose hash is in the upper half."""
        words = list(words) or [f"w{rng.random()}" for _ in range(4)]
        while n:
            word = f"w{rng.randrange(10**9)}"
            if value([*words[-4:], word]) >= 0.5:
                words.append(word)
                n -= 1
        return words

    def passage(words, low):
        """``words`` and one word 18 times, which is one shingle 14 times, its hash in the tenth that begins at ``low``."""
        while True:
            word = f"w{rng.randrange(10**9)}"
            run = [*words[-4:], *[word] * 5]
            if low <= value(run[-5:]) < low + 0.1 and all(value(run[i : i + 5]) >= 0.5 for i in range(len(run) - 5)):
                return [*words, *[word] * 18]

    prefixes = [[]]
    for k in range(3):
        prefixes.append(passage(prefixes[-1], k / 10))
    leads = [more(p, n + 4 - len(p) if p else n) for n, p in zip(range(85, 89), prefixes)]
    core = more(prefixes[-1], 34)
    return [" ".join(t) for t in (*leads, more(core, 7), more(core, 7))]


def linked(spark, monkeypatch, texts, buckets):
    """{(place, place)} of the links of texts of equal shingle weights that share the buckets given as lists of places."""
    nodes = [hashlib.md5(t.encode()).digest() for t in texts]
    counts = [len(t.split(" ")) - 4.0 for t in texts]
    rows = [(g, nodes[i], counts[i]) for g, places in enumerate(buckets) for i in places]
    monkeypatch.setattr(m, "feature_idf", lambda *a, **k: np.ones(1 << 18))
    monkeypatch.setattr(m, "band_table", lambda *a, **k: spark.createDataFrame([(g, bytearray(n), w) for g, n, w in rows], "grp long, node binary, weight double"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {tuple(sorted((nodes.index(bytes(r.a)), nodes.index(bytes(r.b))))) for r in m.near_links(docs).collect()}


def test_links_behind_many_leaders(spark, monkeypatch):
    """x and y meet in round 5 only, after rounds that join nothing; comparing all that is left at once finds the same."""
    for pairs in (0, 100):
        monkeypatch.setattr(m, "PAIRS", pairs)
        assert linked(spark, monkeypatch, nested_texts(), [range(6)]) == {(4, 5)}


def test_pairs_compared_without_a_list_get_one_when_needed(spark, monkeypatch):
    """Lead 1 and x are alone in a bucket first, and then keep x and y apart in a group of three."""
    texts = nested_texts()
    monkeypatch.setattr(m, "PAIRS", 0)
    assert linked(spark, monkeypatch, texts, [[0, 1, 4, 5], [1, 4]]) == {(4, 5)}


def test_samples_agree_as_often_as_weights():
    rng = np.random.default_rng(5)
    sampler = m.Sampler(np.ones(1 << 18))
    values = np.sort(rng.integers(0, 2**63, 300, dtype=np.uint64))
    both = np.concatenate((values[:240], values[60:]))
    counts = np.ones(480, np.int64)
    hits = total = 0
    for seed in range(40):
        out, _ = m.Sampler(sampler.idf, seed).signatures(both, np.repeat([0, 1], 240), counts, 2)
        hits += (out[0] == out[1]).sum()
        total += m.BANDS
    assert abs(hits / total - (180 / 300) ** 4) < 0.05


def ranked_whole(sampler, values, of, counts, n):
    """Signatures with every shingle of every text ranked in every sample."""
    r, per_r, ln_c, b, factors = sampler._draws
    out, samples = np.zeros((n, m.BANDS), np.uint64), np.zeros((n, m.BANDS * m.ROWS), np.uint16)
    ln_w = np.log(sampler.weights(values, counts)).astype(np.float32)
    has, starts, sizes = np.unique(of, return_index=True, return_counts=True)
    inside = np.repeat(np.arange(len(has)), sizes)
    for j, factor in enumerate(factors):
        draw = (values * factor) >> np.uint64(48)
        own_r, own_b = r[draw], b[draw]
        level = np.floor(ln_w * per_r[draw] + own_b)
        rank = ln_c[draw] - own_r * (level - own_b) - own_r
        least = np.flatnonzero(rank == np.minimum.reduceat(rank, starts)[inside])
        least = least[np.unique(inside[least], return_index=True)[1]]
        drawn = sh.mixed(values[least] + level[least].astype(np.int64).astype(np.uint64) * factor)
        out[has, j // m.ROWS] = sh.mixed(out[has, j // m.ROWS] + drawn)
        samples[has, j] = drawn >> np.uint64(48)
    return out, samples


def test_samples_are_those_of_all_shingles(monkeypatch):
    rng = random.Random(13)
    idf = 1 + 0.5 * np.random.default_rng(3).random(1 << 18)
    texts = [None, "", " ", "one", "a b c d e", "ab " * 4000, "ab cd " * 90 + prose(rng, 70), prose(rng, 90_000)]
    texts += [prose(rng, rng.choice((1, 6, 40, 300, 2000))) for _ in range(150)] + ["end", None]
    shingled = sh.distinct_shingles(pa.array(texts), 5)
    assert shingled[2].max() > 1 << m._CLASSES
    for table in (idf, np.ones(1 << 18)):
        sampler = m.Sampler(table, 4)
        want = ranked_whole(sampler, *shingled, len(texts))
        # Where too little is likely to be ranked, texts are ranked anew; where all is, nothing is left out.
        for likely in (m._LIKELY, 0.5, 1e-9, 1e9):
            monkeypatch.setattr(m, "_LIKELY", likely)
            got = sampler.signatures(*shingled, len(texts))
            assert all((x == y).all() for x, y in zip(got, want))
            monkeypatch.undo()


def test_most_shingles_of_a_sample_are_not_ranked():
    """Sampling texts of 400 words takes well under the time of ranking all their shingles."""
    rng = np.random.default_rng(9)
    values, of, counts = rng.integers(0, 1 << 63, 80_000, np.uint64) * np.uint64(2), np.repeat(np.arange(200), 400), np.ones(80_000, np.int64)
    sampler = m.Sampler(1 + 0.5 * rng.random(1 << 18))

    def seconds(sign):
        times = []
        for _ in range(4):
            start = time.process_time()
            for a in range(0, 80_000, m._BLOCK):  # both in blocks that stay in a core's cache
                piece = slice(a, a + m._BLOCK)
                sign(values[piece], of[piece], counts[piece], 200)
            times.append(time.process_time() - start)
        return min(times)

    assert seconds(sampler.signatures) < 0.65 * seconds(lambda *args: ranked_whole(sampler, *args))


def test_lone_and_nameless_documents(spark, empty):
    assert m.near_classes(empty).count() == 0 and m.keep_one(empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "q")], "doc_id long, text string")
    assert m.keep_one(nameless).count() == 2


def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        theirs = words(item_text)
        n = min(len(theirs), 10)
        windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for p in range(len(own) - n + 1):
            if tuple(own[p : p + n]) in windows:
                hit.update(range(p, p + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_winnowing(spark, hard, hard_texts):
    rng = random.Random(2)
    long = [t for t in hard_texts if 400 < len(t or "") < 3000]
    cut = [" ".join(t.split(" ")[5:22]) for t in rng.sample(long, 5)]
    items = [(k, t) for k, t in enumerate([*cut, cut[0].upper(), "a b " * 9, "three", "Two, THREE", "", None, "ab " * 12, prose(rng, 30), "10 of 12"])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = {(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect()}
    got = w.contamination(hard, benchmark).collect()
    assert len(got) == hard.count()
    want = Counter()
    for r in hard.select("doc_id", "text").collect():
        n, hit, found = brute_hits(r.text, items)
        want[r.doc_id, n, hit, tuple(found)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    kept = w.drop_contaminated(hard, benchmark)
    assert kept.columns == hard.columns
    assert {(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()} == {x for x in texts if not brute_hits(x[1], items)[1]}


def test_large_benchmarks_are_joined_by_shuffle(spark, hard, monkeypatch):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30))), (2, "one")], "item_id long, text string")
    want = w.contamination(hard, items).select("doc_id", "n_hit").collect()
    monkeypatch.setattr(w, "BROADCAST_ROWS", 0)
    assert sorted(map(str, w.contamination(hard, items).select("doc_id", "n_hit").collect())) == sorted(map(str, want))


def test_nothing_to_decontaminate(spark, hard, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert w.contamination(empty, none).count() == 0
    assert w.contamination(hard, none).filter(F.col("n_hit") > 0).isEmpty()
    assert w.drop_contaminated(hard, none).count() == hard.count()


def test_chunk_bounds_cover_all_rows():
    from penprint.llm import shingles as sh

    batch = pa.record_batch([pa.array(["x" * 3_000_000, None, "y", "z" * 5_000_000, "q"])], names=["t"])
    assert [r for c in sh.chunks(batch, 0) for r in c.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_features_are_counted_in_little_memory():
    import tracemalloc

    text = " ".join(f"w{i % 997}" for i in range(2000))
    batch = pa.record_batch([pa.array([text] * 1000)], names=["text"])  # 9 MB
    tracemalloc.start()
    [counted] = m.feature_counts(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counted.column("n").to_pylist()[-1] == 1000 and counted.column("feature").to_pylist()[-1] == -1
    assert set(counted.column("n").to_pylist()) == {1000}
    assert peak < 30_000_000


def weighted_pairs(texts, idf, least):
    """Pairs of texts whose weighted Jaccard similarity is ``least`` or more, by the operator's weights."""
    sampler = m.Sampler(idf)
    bags = []
    for t in texts:
        values, _, counts = sh.distinct_shingles(pa.array([t]), 5)
        bags.append(dict(zip(values.tolist(), sampler.weights(values, counts).tolist())))
    out = set()
    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            shared = sum(min(w, b[k]) for k, w in a.items() if k in b)
            if a and b and shared / (sum(a.values()) + sum(b.values()) - shared) >= least:
                out.add((j, i))
    return out


def alike(rng, n, words, share):
    """Texts around one, each with a share of the words replaced: most pairs are near the threshold."""
    core = prose(rng, words).split(" ")
    return [" ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in core) for _ in range(n)]


def test_classes_by_the_operators_own_weights(spark, monkeypatch):
    rng = random.Random(21)
    texts = sorted({*alike(rng, 60, 150, 0.012), *alike(rng, 60, 100, 0.02), *alike(rng, 40, 60, 0.05), *(prose(rng, 80) for _ in range(40))})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    links = weighted_pairs(texts, m.feature_idf(docs), 0.8)
    assert len(links) > 300
    # By samples, in tiles of few nodes, and by leaders alone: no link across two classes.
    for settings in ({"BLOCK_NODES": 7}, {"PAIRS": 0}):
        with monkeypatch.context() as one:
            for name, value in settings.items():
                one.setattr(m, name, value)
            got = {r.doc_id: r.class_id for r in m.near_classes(docs).collect()}
        apart = [p for p in links if got[p[0]] != got[p[1]]]
        assert len(apart) <= 2, (settings, apart)
        # And nothing is joined but by links.
        parent = {i: i for i in got}
        for i, j in sorted(links):
            x, y = i, j
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        for i in got:
            x = i
            while parent[x] != x:
                x = parent[x]
            assert got[i] >= x


def test_clashing_names_are_kept(spark):
    rows = [(1, "one two three four five six", 7, 8), (2, "one two three four five six", 7, 8), (None, "seven", 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _head_id int, label int")
    assert sorted(r.text for r in m.keep_one(docs).select("text", "_head_id", "label").collect()) == ["one two three four five six", "seven"]
