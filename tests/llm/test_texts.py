"""Sharding, packing, scoring, quality, sampling, rules and chat rotation against plain versions."""

import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import AWKWARD, CLASHING, SF, documents, lower, words
from pyarrow import parquet
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm import (
    backoff_scoring, chat_rotation, histogram_packing, lattice_sampling, packed_ids, quality_model, queries,
    ring_sharding, rule_cascade, tokens,
)
from wayfare.session import ship_package
from wayfare.sources.tables import table

WORD_IDS = queries.public_tokenizer("word_bpe_49k.json")
PIECES = queries.public_tokenizer("piece_bpe_32k.model")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def given(spark, sf=SF):
    return [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


def crc(value) -> int | None:
    return None if value is None else zlib.crc32(str(value).encode())


# sharding

def check_shards(rows, got, shards):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("which", ["awkward", "none", "given"])
def test_shards_are_even_and_slots_gapless(spark, which):
    rows = {"awkward": AWKWARD, "none": [], "given": given(spark)}[which]
    check_shards(rows, ring_sharding.sharded(documents(spark, rows)).collect(), 8)


def test_rooms_follow_the_ring():
    """Every document of an arc goes to the first shard clockwise that is not full yet."""
    owners, shards = [0, 1, 0, 2, 1, 2, 0], 3
    counts = {0: 9, 1: 0, 2: 4, 3: 1, 4: 2, 6: 6}
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    expected = []
    for arc in range(len(owners)):
        for rank in range(counts.get(arc, 0)):
            at = arc
            while not room[owners[at % len(owners)]]:
                at += 1
            room[owners[at % len(owners)]] -= 1
            expected.append((arc, rank, owners[at % len(owners)]))
    got = []
    for r in ring_sharding.rooms_for(counts, owners, shards):
        got += [(r["arc"], r["first"] + i, r["shard"]) for i in range(r["n"])]
    assert sorted(got) == sorted(expected)


def test_few_documents_move_when_a_shard_is_added(spark):
    docs = table(spark, SF.replace("0.001", "0.01"), "documents")
    old = {r["doc_id"]: r["shard"] for r in ring_sharding.sharded(docs, 8).collect()}
    new = {r["doc_id"]: r["shard"] for r in ring_sharding.sharded(docs, 9).collect()}
    moved = sum(old[d] != new[d] for d in old) / len(old)
    assert moved < 0.45  # 1/9 must move; without a ring 8/9 would


def test_one_point_takes_arcs_around_the_ring():
    arcs = ring_sharding.arcs_of([(10, 1), (500, 0)])
    owner = {p: a["arc"] for a in arcs for p in range(a["first"], a["last"] + 1)}
    assert len(owner) == ring_sharding.POINTS
    assert (owner[0], owner[10], owner[11], owner[500], owner[501]) == (0, 0, 1, 1, 0)


# ids and packing

def ids_of(text):
    tokenizer = Tokenizer.from_file(WORD_IDS)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_of_words_are_those_of_the_tokenizer():
    """Words of letters and marks, among them letters whose small or normal form has a mark in it."""
    rnd = random.Random(4)
    letters = [chr(c) for c in range(0x20, 0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    odd = [*"İßΣςıǰŉΐΰﬁǅग़ཛྷ'’", "\u0301", "\u0307"]
    plain = [*"abcXYZ 09", *tokens.MARKS]
    texts = ["GELDİ!", "HALİ.", "İ,", "İstanbul.", "ΟΔΟΣ.", "don't", "ග़:"]
    for _ in range(20_000):
        kinds = rnd.choices((letters, odd, plain), (2, 2, 5), k=rnd.randint(1, 12))
        texts.append("".join(rnd.choice(kind) for kind in kinds))
    table, tokenizer = tokens.WordIds(WORD_IDS), Tokenizer.from_file(WORD_IDS)
    for text, found in zip(texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        assert table.encode(text) == packed_bytes(found.ids), text


def test_new_words_are_told_apart():
    """Also where a text has the separator itself, special tokens, or words without ids."""
    tokenizer = Tokenizer.from_file(WORD_IDS)
    for text in ["ab cd \x7f ef", "ab\x7f cd", "\x7fab cd", "\x7f", "ab \x7f\x7f cd.", "ab \u3000 \x85 cd",
                 "x<|endoftext|>y z <|endoftext|>", "\u0301 \u0301 e \u0301e", "one two, three! don't 12 é"]:
        table = tokens.WordIds(WORD_IDS)
        for _ in range(2):
            assert table.encode(text) == packed_bytes(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_tables_of_long_words_are_emptied():
    """By number alone they would keep all of these; ids stay those of the tokenizer."""
    table, tokenizer = tokens.WordIds(WORD_IDS, most_chars=50_000), Tokenizer.from_file(WORD_IDS)
    rnd = random.Random(7)
    for _ in range(60):
        text = "a " + "".join(rnd.choices("abcdef0123+/", k=5_000))
        assert table.encode(text) == packed_bytes(tokenizer.encode(text, add_special_tokens=False).ids)
        assert sum(map(len, table.words)) < 60_000


def packed_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("which", ["awkward", "none", "given"])
@pytest.mark.parametrize("capacity", [2048, 64])
def test_histogram_packing(spark, which, capacity):
    rows = {"awkward": AWKWARD, "none": [], "given": given(spark)}[which]
    got = histogram_packing.pack_documents(documents(spark, rows), WORD_IDS, capacity).collect()
    expected = []
    for doc_id, text in rows:
        ids = ids_of(text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            expected.append((doc_id, piece, at, len(part), zlib.crc32(packed_bytes(part))))
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(expected, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(r["length"] for r in got)
    assert len(sequences) <= math.ceil(total / capacity) * 1.02 + 1


def test_plan_equals_best_fit_over_pieces():
    draw = np.random.default_rng(2)
    for _ in range(30):
        capacity = int(draw.integers(5, 60))
        lengths = draw.integers(1, capacity + 1, int(draw.integers(0, 200))).tolist()
        slots = histogram_packing.plan(Counter(lengths), capacity)
        assert sum(s["pieces"] for s in slots) == len(lengths)
        rooms: list[int] = []
        for length in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - length)
        used = {s["sequence"] + i // s["each"] for s in slots for i in range(s["pieces"])}
        assert len(used) == len(rooms)


def matrix_documents(rows):
    """doc_id -> its ids, put together from matrices, after checks of each matrix."""
    parts = defaultdict(dict)
    for r in rows:
        flat = np.frombuffer(r["ids"], dtype="<u4")
        assert len(flat) == r["n_rows"] * r["row_length"]
        ends, resets = r["cu_seqlens"], r["resets"]
        assert ends[0] == 0 and ends[-1] == len(flat) and resets == ends[:-1]
        place = packed_ids.positions(np.array(resets), len(flat))
        assert (place[resets] == 0).all() and (np.diff(place)[place[1:] > 0] == 1).all()
        at = iter(resets)
        begin = {}
        for i, (row, n) in enumerate(zip(r["rows"], r["lengths"])):
            begin[i] = next(at)
            while begin[i] // r["row_length"] != row:  # padding closes a row
                begin[i] = next(at)
        for i, (doc, start, n) in enumerate(zip(r["doc_ids"], r["starts"], r["lengths"])):
            parts[doc].setdefault(start, []).append(flat[begin[i]:begin[i] + n].tolist())
    return parts


@pytest.mark.parametrize("which", ["awkward", "none", "given"])
def test_matrices_lose_nothing(spark, tmp_path, which):
    rows = {"awkward": AWKWARD, "none": [], "given": given(spark)}[which]
    matrices = packed_ids.packed(documents(spark, rows), WORD_IDS, length=512, rows=8, group_tokens=20_000)
    packed_ids.write_matrices(matrices, str(tmp_path / "m"))
    read = spark.read.schema(packed_ids.SCHEMA).parquet(str(tmp_path / "m")).collect()
    assert len({r["matrix"] for r in read}) == len(read)
    expected = defaultdict(lambda: defaultdict(list))
    for doc, text in rows:
        ids = ids_of(text)
        for at in range(0, len(ids), 512):
            expected[doc][at].append(ids[at:at + 512])
    got = matrix_documents(read)
    assert {d: {s: sorted(p) for s, p in parts.items()} for d, parts in got.items()} == {
        d: {s: sorted(p) for s, p in parts.items()} for d, parts in expected.items()}


@pytest.mark.parametrize("rows, length, group_tokens", [(3, 7, 60), (4, 16, 1 << 22)])
def test_matrices_are_best_fit_decreasing(spark, rows, length, group_tokens):
    """Every piece and its row against a plain packing; ids beyond 2^53 stay as they are beside null ones."""
    rnd = random.Random(9)
    docs = [(None if i % 5 == 2 else 2 ** 60 + i, " ".join(rnd.choices("ab", k=rnd.randint(0, 30)))) for i in range(80)]
    got = packed_ids.packed(documents(spark, docs).coalesce(1), WORD_IDS, length, rows, group_tokens).collect()
    groups, size = [[]], 0
    for doc, text in docs:
        ids = ids_of(text)
        for at in range(0, len(ids), length):
            groups[-1].append((doc, at, ids[at:at + length]))
            size += len(groups[-1][-1][2])
            if size >= group_tokens:
                groups.append([])
                size = 0
    expected = []
    for group in groups:
        full, room, turn = [], [], []
        for n, piece in enumerate(sorted(group, key=lambda p: -len(p[2]))):
            fits = [i for i, r in enumerate(room) if r >= len(piece[2])]
            if not fits:
                fits = [len(full)]
                full.append([]), room.append(length), turn.append(0)
            row = min(fits, key=lambda i: (room[i], -turn[i]))
            full[row].append(piece)
            room[row] -= len(piece[2])
            turn[row] = n
        expected += [full[at:at + rows] for at in range(0, len(full), rows)]
    assert len(got) == len(expected)
    for number, (r, part) in enumerate(zip(sorted(got, key=lambda r: r["matrix"]), expected)):
        pieces = [(doc, start, len(ids), i) for i, row in enumerate(part) for doc, start, ids in row]
        assert (r["matrix"], r["n_rows"], r["row_length"]) == (number, len(part), length)
        assert list(zip(r["doc_ids"], r["starts"], r["lengths"], r["rows"])) == pieces
        filled = [[x for _, _, ids in row for x in ids] for row in part]
        assert r["ids"] == packed_bytes([x for row in filled for x in row + [0] * (length - len(row))])
    matrix_documents(got)


def test_written_matrices_have_small_row_groups(spark, tmp_path):
    """A task's matrices lie in row groups of some megabytes, and a page has one matrix, however many there are."""
    draw = np.random.default_rng(6)
    bodies = [draw.bytes(1 << 20) for _ in range(40)]
    rows = [(i, 4, 65_536, ids, [0, 262_144], [0], [i], [0], [262_144], [0]) for i, ids in enumerate(bodies)]
    packed_ids.write_matrices(spark.createDataFrame(rows, packed_ids.SCHEMA).coalesce(1), str(tmp_path / "m"))
    file, = (tmp_path / "m").glob("*.parquet")
    groups = parquet.ParquetFile(file).metadata
    sizes = [groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)]
    assert max(sizes) < 12 << 20
    assert [r["ids"] for r in spark.read.parquet(str(tmp_path / "m")).sort("matrix").collect()] == bodies


def test_room_tree_finds_the_least_room_that_is_enough():
    draw = np.random.default_rng(4)
    tree, rooms = packed_ids.RoomTree(100), []
    for step in range(3000):
        if draw.random() < 0.5:
            room = int(draw.integers(0, 101))
            tree.add(room, step)
            rooms.append(room)
        else:
            wanted = int(draw.integers(0, 101))
            found = tree.take(wanted)
            fits = [r for r in rooms if r >= wanted]
            assert (found[0] if found else None) == (min(fits) if fits else None)
            if found:
                rooms.remove(found[0])


# scoring

def brute_scores(rows, prior):
    tokens = [[*(lower(w) for w in words(t)), None] for _, t in rows]
    out = [d is not None and crc(d) % 7 == 2 for d, _ in rows]
    single, pairs = Counter(), Counter()
    for own, held in zip(tokens, out):
        if not held:
            single.update(own)
            pairs.update(zip([None, *own], own))
    n, kinds = sum(single.values()), len(single)
    scored = []
    for (doc, _), own, held in zip(rows, tokens, out):
        base = [(single[w] + 1) / (n + kinds + 1) for w in own]
        smooth = [(pairs[b, w] + prior * p) / (single[b] + prior) for b, w, p in zip([None, *own], own, base)]
        scored.append((doc, held, len(own), sum(single[w] > 0 for w in own), n,
                       sum(map(math.log10, base)), sum(map(math.log10, smooth))))
    return sorted(scored, key=lambda r: (str(r[0]), r[5]))


@pytest.mark.parametrize("which", ["awkward", "none", "given"])
@pytest.mark.parametrize("block_tokens", [500, 2_000_000])
def test_scores(spark, which, block_tokens):
    rows = {"awkward": AWKWARD, "none": [], "given": given(spark)}[which]
    got = backoff_scoring.scored(documents(spark, rows), block_tokens=block_tokens).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[5]))
    expected = brute_scores(rows, backoff_scoring.PRIOR)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for mine, plain in zip(got, expected):
        assert mine[5:] == pytest.approx(plain[5:], rel=1e-9)


def test_weights_of_a_context_add_up_to_one(spark):
    """Over all known words, the end, and one unknown word, after a context that training has."""
    vocabulary = ["a", "b", "c", "d"]
    rows = [(0, "a b a c"), (1, "b b d"), (3, "a d")]
    rows = [r for r in rows if crc(r[0]) % 7 != 2]
    known = sorted({w for _, t in rows for w in t.split()})
    probes = [f"a {w}" for w in known] + ["a", "a unknown"]
    free = [i for i in range(1000) if crc(i) % 7 == 2]
    asked = [(free[i], p) for i, p in enumerate([*probes, "a"])]
    for order in (2, 3):
        got = backoff_scoring.scored(documents(spark, rows + asked), order=order, prior=2.0).collect()
        score = {r["doc_id"]: r["score"] for r in got}
        first = backoff_scoring.scored(documents(spark, rows + asked), order=order, prior=2.0)
        assert first.columns[0] == "doc_id" and len(vocabulary) == 4
        one = score[free[len(probes) - 2]]  # "a" and the end
        assert one < 0
        # p(a w end) summed over w is at most p(a): each has one more factor
        assert sum(10 ** score[free[i]] for i in range(len(known))) < 1


def test_backoff_beats_single_words_on_held_out_texts(spark):
    rows = queries.QUERIES["op7_backoff_scoring"](spark, SF.replace("0.001", "0.01")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


# quality

def test_quality_on_held_out_labels(spark):
    sf = SF.replace("0.001", "0.1")
    scored = queries.QUERIES["op8_quality_model"](spark, sf)
    rows = scored.join(table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert all((crc(r["doc_id"]) % 5 == 0) == r["held_out"] and 0 <= r["score"] <= 1 for r in rows)
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert right > 0.97
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) / len(good) > 0.99


def labelled(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, quality int")
    return table.withColumn("toxic", F.lit(0)).withColumn("x", F.lit("x")).withColumn("fold", F.lit("x"))


@pytest.mark.parametrize("labels", [[], [(4, 1)], [(4, 1), (4, 0), (14, 0), (10, 1), (None, 1), (8, None), (999, 1)]])
def test_quality_of_awkward_documents(spark, labels):
    got = quality_model.score_documents(documents(spark, AWKWARD), labelled(spark, labels)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _ in AWKWARD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    kept = quality_model.accepted(documents(spark, AWKWARD), labelled(spark, labels))
    assert kept.columns == ["doc_id", "text", *CLASHING]
    assert kept.count() == sum(r["predicted"] for r in got)
    assert quality_model.score_documents(documents(spark, []), labelled(spark, labels)).collect() == []


def test_isotonic_is_the_nearest_rising_sequence():
    values, weights = np.array([1.0, 3, 2, 2, 5, 4]), np.array([1.0, 1, 1, 2, 1, 1])
    assert quality_model.isotonic(values, weights) == pytest.approx([1, 2.25, 2.25, 2.25, 4.5, 4.5])


# sampling

def test_samples_are_distinct_and_decode(spark):
    rows = AWKWARD + given(spark)[:60]
    model = lattice_sampling.lattices(PIECES)
    got = lattice_sampling.segmentations(documents(spark, rows), PIECES, k=3)
    got = got.withColumn("text", lattice_sampling.decoded(F.col("ids"), PIECES)).collect()
    normal = Counter((d, zlib.crc32(lattice_sampling.plain(model.model.normalize(t) if t else "").encode())) for d, t in rows)
    by_row = defaultdict(list)
    for r in got:
        by_row[r["doc_id"], r["text_crc32"]].append(r)
    assert set(by_row) == set(normal)
    texts = {(d, zlib.crc32(lattice_sampling.plain(model.model.normalize(t) if t else "").encode())): t or "" for d, t in rows}
    for key, samples in by_row.items():
        first = [r for r in samples if r["sample"] == 0]
        assert len(first) == normal[key]
        values = [r["value"] for r in sorted(samples, key=lambda r: r["sample"])]
        assert values == sorted(values, reverse=True)
        assert len({r["ids"] for r in samples}) == len(samples) // normal[key]
        assert all(r["text"] == texts[key] for r in samples)
        assert all(0 <= r["inclusion"] <= 1 and r["logp"] <= 1e-9 for r in samples)


def all_paths(store, node):
    if store.stop[node]:
        return [((), 0.0)]
    paths = []
    for arc in range(store.first[node], store.first[node] + store.leaving[node]):
        paths += [((arc, *rest), store.logp[arc] + p) for rest, p in all_paths(store, store.to[arc])]
    return paths


def test_samples_follow_the_weights_of_paths():
    """First samples come up as often as they weigh, pairs as drawn without replacement, and all paths end up sampled."""
    store = lattice_sampling.Lattices(PIECES)
    store.add(["▁then", "▁an"])
    node = np.array([store.units["▁then"]])
    paths = dict(all_paths(store, node[0]))
    assert sum(map(math.exp, paths.values())) == pytest.approx(1)
    trials = 4000
    keys = np.arange(trials, dtype=np.uint64) * np.uint64(2_654_435_761)
    drawn = lattice_sampling._Batch(store, keys, [node] * trials).search(2)
    firsts = Counter(tuple(s[0][0]) for s, _ in drawn)
    pairs = Counter((tuple(s[0][0]), tuple(s[1][0])) for s, _ in drawn)
    for path, logp in paths.items():
        assert firsts[path] / trials == pytest.approx(math.exp(logp), abs=0.03)
    for (a, b), n in pairs.items():
        p, q = math.exp(paths[a]), math.exp(paths[b])
        assert a != b and n / trials == pytest.approx(p * q / (1 - p), abs=0.03)
    every, rest = lattice_sampling._Batch(store, keys[:1], [node]).search(len(paths) + 5)[0]
    assert {tuple(a) for a, _, _ in every} == set(paths) and rest == -math.inf
    for arcs, logp, _ in every:
        assert logp == pytest.approx(paths[tuple(arcs)])


def test_inclusion_scores_estimate_sums():
    """Sums over samples, weighted by one over inclusion, are right on average."""
    store = lattice_sampling.Lattices(PIECES)
    store.add(["▁other"])
    node = np.array([store.units["▁other"]])
    paths = dict(all_paths(store, node[0]))
    expected = sum(len(p) * math.exp(w) for p, w in paths.items())
    keys = np.arange(3000, dtype=np.uint64) * np.uint64(40_503) + np.uint64(7)
    estimates = [
        sum(len(a) * math.exp(w) / lattice_sampling._inclusion(w, rest) for a, w, _ in samples)
        for samples, rest in lattice_sampling._Batch(store, keys, [node] * 3000).search(3)
    ]
    assert np.mean(estimates) == pytest.approx(expected, rel=0.03)


def test_samples_depend_on_the_row_alone(spark):
    rows = given(spark)[:30]
    docs = documents(spark, rows)
    one = lattice_sampling.segmentations(docs.repartition(1), PIECES).select("doc_id", "sample", "ids", "value").collect()
    many = lattice_sampling.segmentations(docs.repartition(7), PIECES).select("doc_id", "sample", "ids", "value").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    assert lattice_sampling.segmentations(documents(spark, []), PIECES).collect() == []


# rules

def plain_counts(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


@pytest.mark.parametrize("which", ["awkward", "none"])
def test_counts_and_verdicts(spark, which):
    rows = AWKWARD + [(30, "a b c a b c x a b c"), (31, "a a a a"), (32, "a b"), (33, "a\n b \n\na\nb")] if which == "awkward" else []
    text = F.col("text")
    docs = documents(spark, rows)
    got = rule_cascade.judged(docs).select(
        "doc_id", rule_cascade.n_words(text), rule_cascade.word_chars(text), rule_cascade.n_symbols(text),
        rule_cascade.n_dup_lines(text), rule_cascade.n_repeat_words(text), F.col("failed_rule").isNull(),
    ).collect()
    expected = []
    for doc, t in rows:
        n, chars, symbols, dup, repeat, lines = plain_counts(t)
        kept = (n >= 50 and 100 * repeat <= 50 * n and 100 * symbols <= 5 * chars and 100 * dup <= 50 * lines
                and 2 * n <= chars <= 15 * n)
        expected.append((doc, n, chars, symbols, dup, repeat, kept))
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)
    assert rule_cascade.passing(docs).columns == docs.columns
    assert rule_cascade.passing(docs).count() == sum(r[-1] for r in expected)


def test_order_of_rules_changes_no_verdict(spark):
    docs = table(spark, SF, "documents")
    text = F.col("text")
    verdicts = [
        docs.filter(rule_cascade.first_failed(text, order).isNull()).count()
        for order in (rule_cascade.RULES, rule_cascade.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_cheap_rules_that_reject_come_first(spark):
    docs = documents(spark, [(i, "short") for i in range(50)])
    slow = rule_cascade.Rule("slow", lambda t: rule_cascade.n_repeat_words(t) < 0)
    assert [r.name for r in rule_cascade.ordered_rules(docs, [slow, rule_cascade.too_short(50)])][0] == "too_short"


# dialogues

def test_perspectives_of_awkward_messages(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "who"), (1, 3, None, "who"),
        (2, 0, "system", "alone"), (None, 5, "ann", "lost"), (3, None, "ann", ""), (3, 1, "bob", "x" * 5000),
        (4, 1, "bob", "same turn b"), (4, 1, "ann", "same turn a"),
    ] + [(9, i, f"p{i % 3}", f"message {i} é") for i in range(700)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("place", "part", "speaker", "messages", "conv", "start"):
        messages = messages.withColumn(name, F.lit("x"))
    got = chat_rotation.perspectives(messages, part_messages=100).collect()
    expected = {}
    order = lambda r: [(v is not None, v) for v in (r[1], r[2] or "unknown", r[3] or "")]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        for speaker in {r[2] or "unknown" for r in own} - {"system"}:
            text, spans = "", []
            for _, _, role, said in own:
                role = role or "unknown"
                head = {"system": "<|system|>\n", speaker: "<|assistant|>\n"}.get(role, f"<|user name={role}|>\n")
                body = (said or "") + "<|end|>\n"
                if role == speaker:
                    spans.append((len(text) + len(head), len(text) + len(head) + len(body)))
                text += head + body
            expected[conv, speaker] = text, spans
    found = defaultdict(lambda: ("", []))
    for r in sorted(got, key=lambda r: (str(r["conv_id"]), r["speaker"], r["part"])):
        text, spans = found[r["conv_id"], r["speaker"]]
        assert r["start"] == len(text)
        found[r["conv_id"], r["speaker"]] = (
            text + r["text"], spans + [(s["start"] + len(text), s["end"] + len(text)) for s in r["spans"]])
    assert dict(found) == expected
    assert chat_rotation.perspectives(messages.limit(0)).collect() == []


def test_starts_of_parts_come_from_lengths_alone(spark):
    """The window by speaker, where a long conversation is one task, holds no text."""
    messages = spark.createDataFrame(
        [(1, i, f"p{i % 2}", f"message {i}") for i in range(50)], "conv_id long, turn long, role string, text string")
    parts = chat_rotation.perspectives(messages, part_messages=10)
    plan = parts._jdf.queryExecution().sparkPlan().toString().splitlines()
    windows = [i for i, line in enumerate(plan) if "Window [" in line and "speaker#" in line]
    assert windows
    for i in windows:
        assert "Project [" in plan[i + 1] and "array_join" not in plan[i + 1] and "spans" not in plan[i + 1]
