import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import merkle
from tessera.llm.q_merkle import op13_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        out.append((i & 1, nodes[i ^ 1]) if i ^ 1 < len(nodes) else None)
        i >>= 1
    return out


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (id, text, lang, source, n)."""
    trees = {}
    for doc, text, lang, source, n in rows:
        forged = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        leaf = h(enc(doc), enc(source), enc(lang), enc(n), enc(text))
        claim = h(enc(doc), enc(source), enc(lang), enc(n + 1), enc(text)) if forged else leaf
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf, doc, claim))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    low = {k: plain_tree([r[2] for r in sorted(trees[k], key=lambda r: r[:3])]) for k in order}
    high = plain_tree([low[k][-1][0] for k in order])
    out = []
    for t, k in enumerate(order):
        for i, (_, _, leaf, doc, claim) in enumerate(sorted(trees[k], key=lambda r: r[:3])):
            path = plain_path(low[k], i) + plain_path(high, t)
            at = claim
            for step in path:
                at = h(at) if step is None else h(step[1], at) if step[0] else h(at, step[1])
            out.append((doc, leaf, low[k][-1][0], high[-1][0],
                        h(*[s[1] for s in path if s]), at, at == high[-1][0]))
    return sorted(out, key=repr)


def digests(spark, rows, tmp_path, parts=5, extra=False):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        docs = docs.selectExpr("*", "1 as pos", "2 as tree", "3 as part", "4 as leaf", "5 as n", "6 as _k0")
    docs.repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    df = op13_merkle_manifest(spark, str(tmp_path))
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def sample():
    rng = np.random.default_rng(5)
    langs = ["en"] * 6 + ["de", "fr", None, ""]
    rows = [(int(i), "wörd 😀 " * int(rng.integers(0, 9)), langs[i % 10], f"s{i % 3}" if i % 4 else None,
             int(i) * 3 if i % 5 else None) for i in rng.permutation(700)]
    rows += [(None, None, None, None, None), (None, "x", "en", "s", 1), (3, "", "one", None, 0)]
    return rows + [rows[0], rows[0], (rows[1][0], "other text", rows[1][2], None, 9)] + [
        (9000, "long " * 50_000, "en", "s1", 7)]


def test_manifest_equals_plain_trees(spark, tmp_path):
    rows = sample()
    got = digests(spark, rows, tmp_path, extra=True)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_one_row_and_none(spark, tmp_path):
    one = [(4, "a", "en", "s", 1)]
    assert digests(spark, one, tmp_path / "a", 1) == plain_manifest(one)
    assert digests(spark, [], tmp_path / "b", 1) == []


def test_missing_is_minimal():
    rng = np.random.default_rng(9)
    for size in (1, 2, 3, 7, 8, 13, 64):
        levels = plain_tree([f"{i}" for i in range(size)])
        for _ in range(8):
            known = np.sort(rng.choice(size, rng.integers(1, size + 1), replace=False))
            have = {(0, int(i)) for i in known}
            need = merkle.missing(known, size)
            assert not have & set(need)
            have |= set(need)
            for lv in range(len(levels) - 1):
                for i in range(0, len(levels[lv]), 2):
                    if all((lv, j) in have for j in range(i, min(i + 2, len(levels[lv])))):
                        have.add((lv + 1, i >> 1))
            assert (len(levels) - 1, 0) in have
            # none of them covers a known leaf, or lies under another of them
            for lv, i in need:
                assert not any(k >> lv == i for k in known)
                assert not any(other > lv and i >> (other - lv) == j for other, j in need)


def test_small_and_large_leaf_partitions_agree(spark, monkeypatch):
    rows = spark.range(3000).select(F.concat(F.lit("t"), F.col("id") % 3).alias("lang"), "id")
    def run():
        df = merkle.manifest(rows, F.col("lang"), ["id"], merkle.leaf_digest("id"), {"id": F.col("id")})
        good = df.withColumn("ok", merkle.folded(F.col("leaf"), F.col("path")) == F.col("root"))
        out = {r.id: (r.root, r.path) for r in good.collect() if r.ok}
        assert len(out) == 3000
        return out
    whole = run()
    monkeypatch.setattr(merkle, "MOST_BITS", 2)
    monkeypatch.setattr(merkle, "UP_BITS", 3)
    assert run() == whole
