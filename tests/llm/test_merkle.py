import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

from .helpers import DOCUMENTS, documents, same


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes: list[str], fanout: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def path(tree: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    out = []
    for level in tree[:-1]:
        start = at - at % fanout
        out.append(("".join(level[start:at]), "".join(level[at + 1:start + fanout])))
        at //= fanout
    return out


def plain(rows: list[tuple], fanout: int = 2) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows of DOCUMENTS."""
    groups: dict = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        groups.setdefault(lang, []).append((doc_id, own, leaf(doc_id, source, lang, n_chars + 1, text) if hit else own))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = levels([r[1] for r in groups[lang]], fanout)
    top = levels([trees[g][-1][0] for g in order], fanout)
    out = []
    for g, lang in enumerate(order):
        for i, (doc_id, own, used) in enumerate(groups[lang]):
            steps = path(trees[lang], i, fanout) + path(top, g, fanout)
            for left, right in steps:
                used = sha(left + used + right)
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), used,
                        used == top[-1][0]))
    return out


def digest(docs, fanout=2, height=merkle.HEIGHT):
    found = merkle.manifest(merkle.document_leaves(docs), ["doc_id"], ["tampered"], fanout, height)
    return found.select("doc_id", "node", "subroot", "root", F.sha2(merkle.siblings("path"), 256),
                        merkle.fold("path", "tampered").alias("f"), F.expr("aggregate(path, tampered, (h, p) -> "
                                                                           "sha2(concat(p.left, h, p.right), 256)) = root"))


def rows_of_langs(n: int) -> list[tuple]:
    langs = ["en", "en", "en", None, "", "é", "zz", "Z"]
    return [(r[0], r[1], langs[i * 5 % 8], *r[3:]) for i, r in enumerate(documents(n=n))]


@pytest.mark.parametrize("fanout, height", [(2, 8), (2, 2), (3, 1), (5, 2)])
def test_agrees_with_plain_version(spark, fanout, height):
    """Nulls, ties, repeated rows and clashing column names, in blocks larger and much smaller than the groups."""
    rows = rows_of_langs(40)
    got = digest(spark.createDataFrame(rows, DOCUMENTS), fanout, height)
    same(got.collect(), plain(rows, fanout))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 17])
def test_groups_of_every_size(spark, n):
    rows = [(i, f"t{i}", "en", "s", i, 0, None, None) for i in range(n)] + [(100, "x", "de", None, None, 0, None, None)]
    same(digest(spark.createDataFrame(rows, DOCUMENTS), 2, 2).collect(), plain(rows))


def test_one_row_and_no_row(spark):
    rows = [(5, "t", "en", "s", 1, 0, None, None)]
    got = digest(spark.createDataFrame(rows, DOCUMENTS)).collect()
    same(got, plain(rows))
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")
    assert digest(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_a_hot_group_of_equal_ids_is_numbered_in_parts(spark):
    """Rows without an id, and equal rows, are leaves of their own."""
    rows = [(None, f"t{i % 50}", "en", "s", 1, 0, None, None) for i in range(700)]
    got = digest(spark.createDataFrame(rows, DOCUMENTS), 2, 3).collect()
    same(got, plain(rows))
    assert len({r[3] for r in got}) == 1


def test_a_change_of_any_field_changes_the_root(spark):
    rows = [(i, f"t{i}", "en", "s", i, 0, None, None) for i in range(20)]
    root = digest(spark.createDataFrame(rows, DOCUMENTS)).first()[3]
    for at, value in ((0, 99), (1, "other"), (1, None), (2, "de"), (3, None), (4, 77)):
        changed = list(rows)
        changed[7] = tuple(value if i == at else v for i, v in enumerate(rows[7]))
        assert digest(spark.createDataFrame(changed, DOCUMENTS)).first()[3] != root


def test_values_at_the_ends_of_their_types_and_a_very_long_text(spark):
    rows = [(7, "ab " * 700_000, "en", "s", 2**63 - 1, 0, None, None), (-2**63, "", "en", "", 0, 0, None, None)]
    same(digest(spark.createDataFrame(rows, DOCUMENTS)).collect(), plain(rows))


def test_levels_are_strings_of_blocks(spark):
    nodes = [sha(str(i)) for i in range(11)]
    frame = spark.createDataFrame([("g", i, 11, h) for i, h in enumerate(nodes)], "grp string, pos long, n long, node string")
    tree = merkle.build(frame, fanout=2, height=2)
    assert [layer.count() for layer in tree.layers] == [3, 1]
    want = levels(nodes, 2)
    stored = tree.layers[0].orderBy("block").select("levels").collect()
    for k in range(3):
        assert "".join(r[0][k] for r in stored) == "".join(want[k])
    assert tree.roots.collect()[0]["root"] == want[-1][0]
