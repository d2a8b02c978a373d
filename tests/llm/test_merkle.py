"""Merkle manifest against a plain version, subsets of proofs, and the octopus' minimal unions."""
import zlib
from hashlib import sha256

import numpy as np
import pytest

from aerostar.llm import merkle

KIND = "doc_id long, source string, lang string, n_chars long, text string, Source2 string, KEY string, idx long, hash string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def climb(nodes, at, value=None):
    """(proof, root): siblings of node ``at`` up to the root; ``value`` takes its place."""
    proof, here = "", nodes[at] if value is None else value
    while len(nodes) > 1:
        lo = at - at % 16
        run = nodes[lo:lo + 16]
        proof += "".join(run[:at - lo] + run[at - lo + 1:])
        here = h(*run[:at - lo], here, *run[at - lo + 1:])
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at //= 16
    return proof, here


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    leaves = {s: [leaf(r, r[4]) for r in groups[s]] for s in order}
    subroots = [climb(leaves[s], 0)[1] for s in order]
    out = []
    for j, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            low, sub = climb(leaves[s], i)
            high, root = climb(subroots, j)
            now = leaves[s][i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                now = leaf(r, text)
            folded = climb(subroots, j, climb(leaves[s], i, now)[1])[1]
            out.append((r[0], leaves[s][i], sub, root, low + high, folded, folded == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "=k", 1, "h") for r in rows], KIND).withColumnRenamed("Source2", "TEXT")


def documents(sizes):
    no = 0
    for s, n in sizes.items():
        for i in range(n):
            no += 1
            yield (no * 7, s, None if i % 5 else "en", None if i % 3 == 0 else i, [None, "", "Ab", "ÉZ 漢\n"][i % 4])


CASES = {
    "deep and lone": {None: 1, "": 17, "a": 300, "=": 16, "é": 33, "z": 2},
    "many sources": {f"s{i}": 1 + i % 3 for i in range(290)},
    "one leaf": {"only": 1},
}


@pytest.mark.parametrize("case", CASES)
def test_equals_the_plain_version(spark, monkeypatch, case):
    monkeypatch.setattr(merkle, "PART", 7)
    rows = list(documents(CASES[case]))
    rows += [(None, "a", None, None, "T"), (7, "a", "x", 1, "Q"), (7, "a", "x", 1, "Q"), (21, "a", "x", 1, "w " * 60000)]
    if case == "one leaf":
        rows = rows[:1]
    got = merkle.proofs(merkle.manifest(frame(spark, rows))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows)))


def test_proofs_of_some_leaves_are_the_same(spark):
    rows = list(documents({"a": 600, "b": 40}))
    m = merkle.manifest(frame(spark, rows))
    want = {r[0]: r for r in plain(rows)}
    some = merkle.proofs(m, m.leaves.filter("doc_id % 11 = 3")).collect()
    assert len(some) == sum(r[0] % 11 == 3 for r in rows) and all(tuple(r) == want[r.doc_id] for r in some)


def test_empty_table(spark):
    m = merkle.manifest(frame(spark, []))
    assert m.root is None and merkle.proofs(m).count() == 0


def test_the_union_holds_what_is_needed_and_nothing_derivable():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 5000))
        known = np.unique(rng.integers(0, n, int(rng.integers(1, 40))))
        lacking = {(level, int(i)) for level, at in merkle.missing(known, n) for i in at}
        # Derivable: leaves that are held, and each node above one of them.
        held, width, level, needed = set(known.tolist()), n, 0, set()
        while width > 1:
            for i in held:
                needed |= {(level, j) for j in range(i - i % 16, min(i - i % 16 + 16, width))} - {(level, k) for k in held}
            held, width, level = {i // 16 for i in held}, -(-width // 16), level + 1
        assert lacking == needed


def test_every_tampered_text_is_found(spark):
    found = merkle.op12_merkle_manifest(spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in found.collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in docs[r.doc_id] or "")
        assert r.verified != changed
