from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitlake.llm import simhash
from pitlake.llm.graph import components


def brute_print(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    prints = sorted(root)
    for k, a in enumerate(prints):
        for b in prints[k + 1 :]:
            if (a ^ b).bit_count() <= simhash.MAX_BITS:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def near_prints(n=400):
    random.seed(4)
    out = []
    for _ in range(n // 20):
        base = random.getrandbits(64)
        for _ in range(20):
            for b in random.sample(range(64), random.randrange(0, 4)):
                base ^= 1 << b
            out.append(base)
    return sorted(set(out))


@pytest.mark.parametrize("bound", [4096, 3])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, bound):
    prints = near_prints()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    monkeypatch.setattr(simhash, "PAIRED", bound)
    one = lambda batches: simhash.links_in_lists(batches)
    # the bound is a module value: run the lists in this process so that the patch holds
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(signed, pa.int64())], names=["fp"])
    rows = pa.Table.from_batches(list(simhash.postings(iter([batch])))).sort_by([("a", "ascending"), ("b", "ascending")])
    found = [tuple(r.values()) for b in one(iter(rows.to_batches(max_chunksize=37))) for r in b.to_pylist()]
    links = {(a, b) for a, b in found if a != b}
    hot = sorted({a for a, b in found if a == b})
    assert bool(hot) == (bound == 3)
    if hot:
        near = pa.Table.from_batches(list(simhash.neighbours(iter([
            pa.RecordBatch.from_arrays([pa.array(hot, pa.int64())], names=["fp"])
        ])))).sort_by([("a", "ascending"), ("b", "ascending")])
        for b in simhash.links_by_neighbour(iter(near.to_batches(max_chunksize=1001))):
            links |= {tuple(r.values()) for r in b.to_pylist()}
    mask = (1 << 64) - 1
    assert all(((a & mask) ^ (b & mask)).bit_count() <= simhash.MAX_BITS for a, b in links)
    got = {r.node & mask: r.root for r in components(spark.createDataFrame(list(links), "a long, b long")).collect()}
    want = brute_roots(prints)
    same = {}
    for p in prints:
        assert same.setdefault(want[p], got.get(p, p)) == got.get(p, p)
    assert len(set(same.values())) == len(same)


def test_fingerprints():
    random.seed(1)
    texts = [None, "", " \t", "One", "one two three", "A b C d", "É é ß", " ".join(random.choices("abcdef", k=5000))]
    for text in texts:
        for size in (4, 5):
            assert simhash.fingerprint(text, size) & (2**64 - 1) == brute_print(text, size)


def test_report_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text, 4) for r in rows}
    roots = brute_roots(prints.values())
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    want = {(i, f"{p:016x}", least[roots[p]]) for i, p in prints.items()}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.report(docs).collect()} == want


def test_nulls_ties_and_clashing_columns(documents):
    long = " ".join(str(k) for k in range(3000))
    near = long.replace(" 77 ", " changed ")
    rows = [(5, long), (2, near), (None, long), (9, None), (8, ""), (2, near), (3, "something else entirely here now")]
    docs = documents(rows).withColumn("file", F.lit(1)).withColumn("fp", F.lit(2)).withColumn("root", F.lit(3))
    got = {(r.id, r.component) for r in simhash.near_groups(docs).collect()}
    assert got == {(5, 2), (2, 2), (None, 2), (9, 8), (8, 8), (3, 3)}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 8]
    assert simhash.near_groups(documents([])).count() == 0


def test_similar_texts_are_found_and_others_left(spark, documents):
    random.seed(12)
    words = ["".join(random.choice("abcdefghij") for _ in range(4)) for _ in range(3000)]
    rows, base = [], [random.choices(words, k=400) for _ in range(30)]
    for i, own in enumerate(base):
        rows.append((10 * i, " ".join(own)))
        for k in range(1, 4):  # similarity about 0.9
            near = list(own)
            for at in random.sample(range(400), 4):
                near[at] = "changed"
            rows.append((10 * i + k, " ".join(near)))
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    assert len({r for r in got.values()}) == 30 and all(c == i // 10 * 10 for i, c in got.items())


def test_every_near_pair_shares_a_list():
    random.seed(9)
    for _ in range(2000):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), 4):
            b ^= 1 << bit
        diff = np.array([a ^ b], np.uint64).view(np.int64)
        assert simhash.FIRST_LIST[simhash.shared_mask(diff)[0]] < len(simhash.SUBSETS)


def brute_similar(texts, words=5):
    """Component (least identifier) over all pairs at 0.8 or more."""
    sets = {}
    for i, text in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))}
    root, order = {i: i for i in sets}, sorted(sets)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_similarity_is_decided_at_the_limit_in_both_directions(documents):
    """Sets of 90 shingles: 80 in common are exactly 0.8, 79 are below; and single edits from 0.7 to 0.9."""
    random.seed(21)
    rows, many = [], [f"w{k}" for k in range(100_000)]
    for i in range(150):
        own = random.sample(many, 94)
        rows.append((100 * i, " ".join(own)))
        for k, changed in enumerate((10, 11, random.randrange(5, 17))):
            rows.append((100 * i + k + 1, " ".join(own[changed:] + random.sample(many, changed))))
    random.shuffle(rows)
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    want = brute_similar(dict(rows))
    assert got == want and len({want[100 * i + 1] for i in range(150)} & {100 * i for i in range(150)}) == 150


@pytest.mark.parametrize("bound", [256, 4])
def test_foreign_texts_in_a_list_hide_no_pair(documents, monkeypatch, bound):
    """Texts with a passage in common, few of them near copies, that meet in long lists."""
    monkeypatch.setattr(simhash, "LISTED", bound)
    random.seed(22)
    many, passage = [f"w{k}" for k in range(2000)], [f"p{k}" for k in range(300)]
    rows = []
    for i in range(60):
        own = random.choices(many, k=random.choice((5, 20, 60, 80, 300)))
        rows.append((10 * i, " ".join(passage + own)))
        if i % 3 == 0:
            rows.append((10 * i + 1, " ".join(passage + own[:-3] + ["x", "y", "z"])))
    random.shuffle(rows)
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    assert got == brute_similar(dict(rows))


def test_all_members_of_a_list_are_paired():
    import pyarrow as pa
    from fractions import Fraction

    sizes = [1, 2, 3, 9, 4, 1, 1, 12, 2, 30]
    rows = [(i, 100 * i + m, 50, 0) for i, s in enumerate(sizes) for m in range(s)]
    for chunk in (1, 4, 7, 1000):
        parts = [rows[k : k + chunk] for k in range(0, len(rows), chunk)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], names=simhash.POSTING.names) for p in parts]
        found = [r for b in simhash.pairs_in_lists(iter(batches), Fraction(4, 5), 8) for r in b.to_pylist()]
        pairs = {(r["a"], r["b"]) for r in found if r["list"] is None}
        assert pairs == {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and sizes[x[0]] <= 8}
        long = [(r["list"], r["a"], r["b"]) for r in found if r["list"] is not None]
        assert sorted(long) == [(x[0], x[1], 100 * x[0]) for x in rows if sizes[x[0]] > 8]


def test_overlaps_of_sets_equal_counting_one_by_one(monkeypatch):
    monkeypatch.setattr(simhash, "COLUMNS", 7)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, n).astype("<u8")) for n in (1, 5, 40, 40, 90, 3)]
    got = simhash._overlaps(sets[:2], sets[2:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:]] for a in sets[:2]]


def test_a_long_list_of_texts_not_alike_enough_writes_no_pairs(spark, documents, monkeypatch):
    """Texts of one template with a word changed each lie at 0.7: no links, and rows by member and block only."""
    monkeypatch.setattr(simhash, "LISTED", 20)
    monkeypatch.setattr(simhash, "BLOCK", 32)
    template = [f"t{k}" for k in range(60)]
    rows = []
    for i in range(120):
        words = list(template)
        words[5 + i % 50] = f"own{i}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[i][1] + " tail") for i in range(0, 120, 10)]
    rows += [(300, " ".join(template))]
    written = []
    plain = simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, name: written.append((name, plain(df, name))) or written[-1][1])
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    assert got == brute_similar(dict(rows))
    pairs = {name: df.count() for name, df in written if name in ("candidates", "links-across", "loose-pairs")}
    assert sum(pairs.values()) < 133 * 132 / 2 / 4  # of all pairs


def test_a_forest_joins_what_all_links_join():
    rng = np.random.default_rng(7)
    for size in (0, 1, 30, 400):
        a, b = np.sort(rng.integers(0, 60, (2, size)), axis=0)
        a, b = a[a != b], b[a != b]
        x, y = simhash.forest(a, b)
        assert len(x) <= 59 and set(zip(x.tolist(), y.tolist())) <= set(zip(a.tolist(), b.tolist()))

        def classes(links):
            root = list(range(60))
            for p, q in links:
                root = [root[p] if r == root[q] else r for r in root]
            return [root.index(r) for r in root]

        assert classes(zip(x.tolist(), y.tolist())) == classes(zip(a.tolist(), b.tolist()))


def test_the_byte_index_finds_near_copies_by_itself(documents, monkeypatch):
    """Without the completion: nine of ten pairs at exactly 0.8, nearly all at 0.85 and more, none below 0.8."""
    monkeypatch.setattr(simhash, "completed", lambda known, *rest: known)
    random.seed(23)
    rows, many = [], [f"w{k}" for k in range(100_000)]
    changes = {10: 300, 7: 100, 4: 100, 11: 100}  # of 94 words: similarity 0.8, 0.856, 0.915, 0.782
    for i, changed in enumerate(c for c, n in changes.items() for _ in range(n)):
        own = random.sample(many, 94)
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[changed:] + random.sample(many, changed)))]
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    want = brute_similar(dict(rows))
    found = {i for i in got if got[i] != i}
    assert found <= {i for i in want if want[i] != i}
    assert len([i for i in found if i < 600]) >= 0.9 * 300 and len([i for i in found if i >= 600]) >= 0.98 * 200


def test_lists_of_bytes_lose_no_member(monkeypatch):
    """Members in reach hang together in short and long lists, in whatever batches they come, by a row a member."""
    import pyarrow as pa

    monkeypatch.setattr(simhash, "HELD", 40)
    rng = np.random.default_rng(3)
    rows = []
    for n, size in enumerate([1, 2, 5, simhash.SHORT, simhash.SHORT + 1, 1, 70, 2, 130]):
        far = rng.integers(-(2**62), 2**62, 3)
        rows += [(n, 1000 * n + m, int(far[m % 3]) ^ (1 << m % 5)) for m in range(size)]
    near = {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and (x[2] ^ y[2]).bit_count() <= 2}
    firsts = {1000 * n + m for n in range(9) for m in range(3)}
    for chunk in (1, 7, 50, 1000):
        parts = [rows[k : k + chunk] for k in range(0, len(rows), chunk)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], names=simhash.PLACED.names) for p in parts]
        got = {(r["a"], r["b"]) for b in simhash.pairs_by_bytes(iter(batches), 2) for r in b.to_pylist()}
        assert got <= near and len(got) == len({b for _, b in got})
        assert {b for _, b in got} == {r[1] for r in rows} - firsts


def test_minimum_of_shared_bytes_and_bits_at_the_limit():
    assert simhash.most_bits(0.8) == 246 and simhash.most_bits(0.8, deviations=simhash.NEAR) == 183
    assert simhash.least_bytes(0.8) == 21 and simhash.least_bytes(0.9) > 30
    dealt = np.bincount(simhash.PLACES.ravel(), minlength=128)
    assert len(simhash.PLACES) == 210 and dealt.min() >= 3 and dealt.max() == 5


def test_members_of_one_component_are_not_paired_again():
    import pyarrow as pa

    root = [0, 0, 0, 3, 0, 5, 3]
    rows = [(9, m, 7, r) for m, r in enumerate(root)] + [(10, m, 7, 0) for m in range(40)] + [(11, 1, 7, 0), (11, 50, 6, 50)]
    for chunk in (1, 3, 100):
        parts = [rows[k : k + chunk] for k in range(0, len(rows), chunk)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], names=simhash.TURN.names) for p in parts]
        got = sorted(tuple(r.values()) for b in simhash.pairs_by_bytes(iter(batches), 2) for r in b.to_pylist())
        assert got == [(0, 3, 0, 3, 0), (0, 5, 0, 5, 0), (0, 6, 0, 3, 0), (1, 50, 0, 50, 1), (3, 4, 0, 3, 0)]


def test_a_group_of_near_copies_is_joined_from_few_pairs(documents, monkeypatch):
    """Texts with a passage in common, many of them near copies: the byte index compares and links few pairs a text."""
    monkeypatch.setattr(simhash, "completed", lambda known, *rest: known)
    random.seed(24)
    many, passage = [f"w{k}" for k in range(5000)], [f"p{k}" for k in range(200)]
    rows = []
    for i in range(300):
        words = list(passage)
        for at in random.sample(range(200), 2 if i % 2 else random.randrange(3, 9)):
            words[at] = random.choice(many)
        rows.append((i, " ".join(words)))
    random.shuffle(rows)
    written, plain = [], simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, name: written.append((name, plain(df, name))) or written[-1][1])
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    want = brute_similar(dict(rows))
    assert all(want[i] == want[c] for i, c in got.items()) and len(set(got.values())) <= 1.1 * len(set(want.values())) < 200
    counts = [(name, df.count()) for name, df in written if name in ("met-by-bytes", "loose-pairs", "similar-pairs")]
    assert sum(n for _, n in counts) < 30 * 300, counts


def test_texts_of_long_lists_travel_a_few_times_each(spark, documents, monkeypatch):
    """Texts at 0.77 that meet in many long lists, and texts with little more than a list in common."""
    monkeypatch.setattr(simhash, "LISTED", 20)
    monkeypatch.setattr(simhash, "BLOCK", 32)
    random.seed(25)
    many, template, passage = [f"w{k}" for k in range(50_000)], [f"t{k}" for k in range(200)], [f"p{k}" for k in range(12)]
    rows = []
    for i in range(100):
        words = list(template)
        for at in range(i % 10, 200, 40):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[i][1] + " tail") for i in range(0, 100, 10)]
    rows += [(300 + i, " ".join(passage + random.sample(many, 30))) for i in range(100)]
    rows += [(500, rows[-1][1] + " tail")]
    random.shuffle(rows)
    kind, travelled = type(spark.range(0)), []
    plain = kind.mapInArrow

    def seen(df, *args, **options):
        if {"side", "text"} <= set(df.columns):
            travelled.append(df.count())
        return plain(df, *args, **options)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    got = {r.id: r.component for r in simhash.similar_groups(documents(rows)).collect()}
    assert got == brute_similar(dict(rows))
    assert travelled and sum(travelled) < 4 * len(rows), travelled


def test_counts_leave_every_similar_pair_in_its_block():
    import pyarrow as pa
    from fractions import Fraction

    rng = np.random.default_rng(8)
    sets, blocks = [], []
    for block, size in enumerate([1, 2, 30, 90, 5]):
        base = rng.integers(0, 2**64, 100, "u8")
        for _ in range(size):
            changed = int(rng.choice([2, 10, 11, 20, 100]))
            sets.append(np.unique(np.concatenate([base[changed:], rng.integers(0, 2**64, changed, "u8")])))
            blocks.append(block)
    sets += [np.unique(rng.integers(0, 2**64, 90_000, "u8"))] * 2  # counts beyond the most that is kept
    blocks += [5, 5]
    roots = [k if k % 7 else 0 for k in range(len(sets))]
    rows = [
        (7, 0, b, k % 2, k, r, len(s), simhash.counted(s)) for k, (b, r, s) in enumerate(zip(blocks, roots, sets, strict=True))
    ]
    want = set()
    for x in rows:
        for y in rows:
            both = len(np.intersect1d(sets[x[4]], sets[y[4]])) if x[2] == y[2] and x[3] < y[3] and x[5] != y[5] else 0
            if both and 5 * both >= 4 * (x[6] + y[6] - both):
                want |= {x[4], y[4]}
    found = []
    for chunk in (1, 7, 50, 1000):
        parts = [rows[k : k + chunk] for k in range(0, len(rows), chunk)]
        names = ["list", "left", "right", "side", "a", "a_root", "n", "counts"]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*p)], names=names) for p in parts]
        out = [tuple(r.values()) for b in simhash.alike_in_blocks(iter(batches), Fraction(4, 5)) for r in b.to_pylist()]
        assert len(out) == len(set(out)) and set(out) <= {(7, x[4], x[5]) for x in rows}
        found.append(sorted(out))
    assert found[1:] == found[:-1] and want <= {a for _, a, _ in found[0]} and {len(sets) - 2, len(sets) - 1} <= want
    far = [(7, 0, 0, k % 2, k, k, 100, simhash.counted(rng.integers(0, 2**64, 100, "u8"))) for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*far)], names=names)
    assert not list(simhash.alike_in_blocks(iter([batch]), Fraction(4, 5)))


def test_lists_of_the_same_members_are_put_together(spark):
    alike = [(n, m, 0) for n in range(40) for m in range(300) if (m * 31 + n * 17) % 10]
    apart = [(100 + n, 1000 * n + m, m) for n in range(1, 20) for m in range(40)] + [(100 + n, 5, 0) for n in range(1, 20)]
    members = spark.createDataFrame(alike + apart, "list long, a long, a_root long")
    for seed in range(simhash.GATHERED):
        members = simhash.gathered(members, seed)
    rows = [tuple(r) for r in members.collect()]
    assert len(rows) == len(set(rows))
    lists = {}
    for n, a, _ in rows:
        lists.setdefault(n, set()).add(a)
    before = {}
    for n, a, _ in alike + apart:
        before.setdefault(n, set()).add(a)
    assert all(any(x <= y for y in lists.values()) for x in before.values())  # no pair comes apart
    assert len([x for x in lists.values() if 200 < len(x)]) <= 5 and len(lists) >= 19
