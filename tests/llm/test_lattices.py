"""Lattices of units: shared ends, forgetting, and plain versions of their parts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import AWKWARD, documents

from wayfare.llm import lattice_sampling, queries
from wayfare.session import ship_package

PIECES = queries.public_tokenizer("piece_bpe_32k.model")
UNITS = ["▁then", "then", "▁when", "hen", "▁an", "\n", "▁", "▁ᚠn", "ᚠn", "▁" + "nonono" * 9, "▁\U0001F9E0\U0001F9E0"]


def plain_paths(store, text):
    """All segmentations of a short unit by the vocabulary alone, with their weights."""
    if not text:
        return [((), 0.0)]
    paths, pieces = [], {store.model.id_to_piece(i): i for i in range(store.model.get_piece_size())
                         if lattice_sampling._is_text(store.model, i)}
    for n in range(1, len(text) + 1):
        head = text[:n]
        if head in pieces:
            ids, weight = (pieces[head],), -math.log(2.0 - store.model.get_score(pieces[head]))
        elif n == 1:
            ids = tuple(store.bytes_at + b for b in head.encode())
            weight = -len(ids) * math.log(2.0 - lattice_sampling.BYTE_SCORE)
        else:
            continue
        paths += [(ids + rest, weight + w) for rest, w in plain_paths(store, text[n:])]
    return paths


def lattice_paths(store, node):
    if store.stop[node]:
        return [((), 0.0)]
    arcs = range(store.first[node], store.first[node] + store.leaving[node])
    assert all(store.arcs_between(arc) == arcs for arc in arcs)
    paths = []
    for arc in arcs:
        own = tuple(store.ids(np.array([arc]), np.array([0, 1]))[0].tolist())
        paths += [(own + ids, store.logp[arc] + w) for ids, w in lattice_paths(store, store.to[arc])]
    return paths


@pytest.mark.parametrize("together", [True, False])
def test_lattices_have_every_segmentation(together):
    units = ["▁then", "then", "hen", "▁hen", "▁ᚠn", "n", "▁\U0001F9E0"]
    store = lattice_sampling.Lattices(PIECES)
    for part in [units] if together else [[u] for u in units]:
        store.add(part)
    for unit in units:
        plain = dict(plain_paths(store, unit))
        got = dict(lattice_paths(store, store.units[unit]))
        whole = math.log(sum(map(math.exp, plain.values())))
        assert got.keys() == plain.keys()
        assert all(got[ids] == pytest.approx(weight - whole) for ids, weight in plain.items())


def test_units_that_end_alike_share_their_nodes():
    """A lattice per unit made building them the largest part of op9's time."""
    store = lattice_sampling.Lattices(PIECES)
    store.add(["▁walking", "▁talking"])
    nodes, arcs = store.n_nodes, store.n_arcs
    assert nodes == 1 + len("alking") + 2 * len("▁w")
    store.add(["alking", "king"])
    assert (store.n_nodes, store.n_arcs) == (nodes, arcs)
    store.add(["▁balking"])
    assert store.n_nodes == nodes + 2


def test_samples_do_not_depend_on_units_seen_before():
    keys = np.arange(len(UNITS), dtype=np.uint64)
    alone = []
    for key, unit in zip(keys, UNITS):
        store = lattice_sampling.Lattices(PIECES)
        nodes = lattice_sampling._unit_nodes(store, [unit])
        samples, rest = lattice_sampling._Batch(store, keys[key:key + 1], nodes).search(3)[0]
        alone.append(([(store.ids(a, np.array([0, len(a)]))[0].tolist(), w, v) for a, w, v in samples], rest))
    store = lattice_sampling.Lattices(PIECES)
    for order in (UNITS[::-1], UNITS[3:]):
        store.nodes_of(order)
        nodes = lattice_sampling._unit_nodes(store, UNITS)
        got = lattice_sampling._Batch(store, keys, nodes).search(3)
        assert [([(store.ids(a, np.array([0, len(a)]))[0].tolist(), w, v) for a, w, v in s], rest) for s, rest in got] == alone
        store.reset()


def test_rows_are_those_of_lattices_of_their_own(spark):
    ship_package(spark)
    rows = [(d, f"{t} {d} then when" * (d or 1)) for d, t in AWKWARD if t and d is not None and len(t) < 5_000]
    got = lattice_sampling.segmentations(documents(spark, rows).repartition(1), PIECES, checked=True)
    store, expected = lattice_sampling.Lattices(PIECES), Counter()
    for doc_id, text in rows:
        store.reset()
        nodes = lattice_sampling._unit_nodes(store, [store.model.normalize(text)])
        key = np.array([lattice_sampling.key_of(doc_id)], dtype=np.uint64)
        for number, (arcs, logp, value) in enumerate(lattice_sampling._Batch(store, key, nodes).search(3)[0][0]):
            ids = store.ids(arcs, np.array([0, len(arcs)]))[0].tobytes()
            expected[doc_id, number, ids, logp, value] += 1
    assert Counter((r["doc_id"], r["sample"], bytes(r["ids"]), r["logp"], r["value"]) for r in got.collect()) == expected
    assert got.filter("decoded_crc32 <> text_crc32").count() == 0


def test_long_units_have_nodes_of_their_own_beyond_the_shared_end(monkeypatch):
    units = [head + "▁then and when"[:n].replace(" ", "") * m for n, m in ((5, 1), (9, 2), (14, 3)) for head in ("▁", "x", "")]
    plain = lattice_sampling.Lattices(PIECES)
    plain.add(units)
    monkeypatch.setattr(lattice_sampling, "SHARED_ENDS", 3)
    store = lattice_sampling.Lattices(PIECES)
    store.add(units[:4])
    store.add(units[4:])
    keys = np.arange(len(units), dtype=np.uint64)
    got, expected = (
        [([(s.ids(a, np.array([0, len(a)]))[0].tolist(), w, v) for a, w, v in samples], rest)
         for samples, rest in lattice_sampling._Batch(s, keys, lattice_sampling._unit_nodes(s, units)).search(3)]
        for s in (store, plain)
    )
    assert got == expected
    assert all(store.code[store.units[u]] == ord(u[0]) for u in units)


def test_numbers_of_keys():
    numbers, plain, draw = lattice_sampling._Numbers(4), {}, random.Random(3)
    for size in (0, 1, 5, 300, 2_000):
        new = [k for k in (draw.randrange(2**40) for _ in range(size)) if k not in plain]
        new += new[: size // 3]
        first = len(plain)
        got, taken = numbers.add(np.array(new, dtype=np.uint64), first)
        assert sorted(new[i] for i in taken) == sorted(set(new))
        plain.update((new[i], at) for at, i in enumerate(taken.tolist(), first))
        assert got.tolist() == [plain[k] for k in new]
        assert numbers.n == len(plain) and 2 * len(plain) <= max(16, len(numbers.keys))
        asked = list(plain) + [draw.randrange(2**40) for _ in range(100)] + [0]
        assert numbers.get(np.array(asked, dtype=np.uint64)).tolist() == [plain.get(k, -1) for k in asked]


@pytest.mark.parametrize("text", ["", "a", "a\nb", "\n", "\n\n a", "  a   b ", "a \n b", "▁▁a▁\n▁b", "a  \n\n  "])
def test_units_join_to_the_text(text):
    normal = text.replace(" ", "▁")
    units = lattice_sampling.units_of(normal)
    assert "".join(units) == normal
    assert all(u == "\n" or "\n" not in u and "▁" not in u.lstrip("▁") for u in units)
    store = lattice_sampling.Lattices(PIECES)
    store.nodes_of(list(dict.fromkeys(units)))
    assert lattice_sampling._unit_nodes(store, [normal, "", normal])[2].tolist() == [store.units[u] for u in units]


def test_decoding_takes_off_one_space():
    texts = lattice_sampling._piece_texts(PIECES)
    names = texts.to_pylist()
    spaced = next(i for i, t in enumerate(names) if t == b" a")
    bare = next(i for i, t in enumerate(names) if t == b"a")
    ids = np.array([spaced, bare, bare, spaced, spaced], dtype="<u4")
    cuts = np.array([0, 0, 2, 2, 3, 5])
    parts = [b"", b"aa", b"", b"a", b"a a"]
    assert lattice_sampling._decoded_crc32(ids, cuts, texts) == [zlib.crc32(p) for p in parts]
    assert [lattice_sampling._decode(ids[a:b].tobytes(), texts) for a, b in zip(cuts, cuts[1:])] == parts
