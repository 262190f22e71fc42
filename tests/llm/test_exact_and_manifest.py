"""Exact duplicates, the manifest and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from airway.llm.digest_merge import exact_duplicates, shape_of_tree
from airway.llm.merkle_manifest import folded, leaf_hash, merkle_manifest, proof_text, shown
from airway.llm.spelling_variants import spelling_variants

# exact duplicates


def same_digest(c):
    return F.octet_length(c).cast("long") * 0 + 7


def rows_with_copies():
    rng = random.Random(4)
    texts = ["a", "b", "a ", "", None, "é", "x" * 300_000, "same"]
    rows = [(i, rng.choice(texts)) for i in range(-20, 60)] + [(i, "same") for i in range(100, 200)]
    return rows + [(5, "a"), (5, "a"), (None, "only null"), (None, "only null"), (None, "a"), (300, "alone")]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize(("digest", "run_rows"), [(F.xxhash64, 65_536), (same_digest, 3)])
def test_exact_duplicates_equal_a_dictionary(spark, docs_of, keep, digest, run_rows):
    rows = rows_with_copies()
    found = exact_duplicates(docs_of(rows).repartition(5), keep=keep, digest=digest, run_rows=run_rows).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    pick = min if keep == "smallest" else max
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(t.encode()).hexdigest()
        for i in ids:
            want[i, pick(known) if known else None, len(ids), sha] += 1
    assert Counter((r["id"], r["keep_id"], r["n"], r["sha"]) for r in found) == want
    kept = Counter((r["sha"], r["id"]) for r in found if r["kept"])
    assert kept == Counter((key[3], key[1]) for key in {(0, k[1], 0, k[3]) for k in want})


def test_exact_duplicates_after_a_change_of_the_texts(spark, docs_of):
    rows = [(1, "A b"), (2, "a  b"), (3, "ab")]
    found = exact_duplicates(docs_of(rows), normal=lambda c: F.regexp_replace(F.lower(c), r"\s+", " ")).collect()
    assert sorted((r["id"], r["keep_id"], r["kept"]) for r in found) == [(1, 1, True), (2, 1, False), (3, 3, True)]


def test_exact_duplicates_of_no_rows_and_the_tree(spark, docs_of):
    assert exact_duplicates(docs_of([])).count() == 0
    with pytest.raises(ValueError, match="smallest or largest"):
        exact_duplicates(docs_of([]), keep="first")
    for entries in (0, 1, 10, 10**6, 10**10, 10**12):
        radix, rounds = shape_of_tree(entries, 500_000, 6)
        assert 2 <= radix <= 16 and rounds >= 2
        assert radix**rounds * 500_000 >= entries


# manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(level, fanout):
    """Root and, for each leaf, its siblings and the lists of (before, after)."""
    paths, places = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for path, at in zip(paths, places, strict=True):
            run = runs[at // fanout]
            path.append(("".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])))
        places = [at // fanout for at in places]
        level = [digest("".join(run)) for run in runs]
    return level[0], paths


def plain_manifest(rows, fanout):
    groups = defaultdict(list)
    for i, lang, text in rows:
        parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, lang, text)]
        groups[lang].append((i is not None, i or 0, digest("".join(parts))))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: plain_tree([leaf for *_, leaf in sorted(groups[g])], fanout) for g in langs}
    root, tops = plain_tree([trees[g][0] for g in langs], fanout)
    found = []
    for g, top in zip(langs, tops, strict=True):
        for (has, i, leaf), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            proof = "".join(a + b for a, b in path + top)
            found.append((i if has else None, leaf, trees[g][0], root, proof, leaf, root))
    return found


def manifest_of(spark, rows, fanout):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumns(
        {c: F.lit("x") for c in ("group", "digest", "item", "below", "n", "pos", "root", "id")}
    )
    found = merkle_manifest(docs.repartition(3), ["doc_id", "lang", "text"], fanout=fanout, carry={"seen": leaf_hash(*[F.col(c) for c in ("doc_id", "lang", "text")])})
    return found.select(
        "id", shown(F.col("leaf")), shown(F.col("subroot")), shown(F.col("root")), proof_text(F.col("path")), shown(F.col("seen")), folded(F.col("leaf"), F.col("path"))
    )


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_equals_a_plain_tree(spark, fanout):
    rows = [(i, "en", f"text {i}") for i in range(150)] + [(i, "Ünder", "é" * i) for i in range(200, 207)]
    rows += [(300, None, "no language"), (301, "", ""), (302, "zz", None), (None, "en", "no id"), (None, "en", "no id either")]
    rows += [(9, "en", "other text of one id"), (10, "en", "text 10"), (303, "zz", "y" * 400_000), (304, "ﬀ", "1"), (305, "😀", "2")]
    found = sorted((tuple(r) for r in manifest_of(spark, rows, fanout).collect()), key=repr)
    assert found == sorted(plain_manifest(rows, fanout), key=repr)


def test_manifest_of_one_row_and_of_none(spark):
    ((i, leaf, subroot, root, proof, _, back),) = manifest_of(spark, [(1, "en", "a")], 2).collect()
    assert leaf == subroot == root == back and proof == "" and i == 1
    assert manifest_of(spark, [], 2).count() == 0


def test_an_altered_row_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(i, "en" if i % 3 else "de", i) for i in range(40)], "doc_id long, lang string, n long")
    altered = F.when(F.col("doc_id") % 5 == 0, leaf_hash(F.col("doc_id"), F.col("lang"), F.col("n") + 1))
    found = merkle_manifest(docs, ["doc_id", "lang", "n"], carry={"seen": altered})
    back = folded(F.coalesce("seen", "leaf"), F.col("path")) == shown(F.col("root"))
    assert all(r["same"] == (r["id"] % 5 != 0) for r in found.select("id", back.alias("same")).collect())


# spelling variants


def plain_variants(rows, least_count=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= least_count}

    def near(u, v):
        if len(u) == len(v):
            return sum(a != b for a, b in zip(u, v, strict=True)) == 1
        u, v = sorted((u, v), key=len)
        k = next((k for k in range(len(u)) if u[k] != v[k]), len(u))
        return len(v) == len(u) + 1 and v[:k] + v[k + 1 :] == u

    form, count = {}, {}
    for u in n:
        others = [v for v in n if v != u and near(u, v)]
        count[u] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[u] = best if best is not None and n[best] >= 5 * n[u] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], count[w], n.get(form[w])) for w in n)


def found_variants(docs, **options):
    names = ("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r[c] for c in names) for r in spelling_variants(docs, **options).collect())


def test_variants_equal_all_pairs(spark, docs_of):
    rng = random.Random(8)
    words = {"".join(rng.choice("aaabbÀ") for _ in range(rng.randrange(5, 9))) for _ in range(300)} | {"Banana", "bananna", "BANANA", "aaaaaa", "aaaaaaa"}
    words = sorted(words)
    rows = [(i, " ".join(rng.choices(words, [2.0 ** (k % 12) for k in range(len(words))], k=300))) for i in range(60)]
    rows += [(None, "banana ananas " * 9), (70, None), (71, ""), (72, "Größen1größen_GRÖßEN " * 6), (72, "Größen"), (73, "öffnen öfnen " * 5 + "öffnen " * 40)]
    want = plain_variants(rows)
    assert found_variants(docs_of(rows)) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] not in (None, r[2]) for r in want)


def test_variants_of_very_long_words(spark, docs_of):
    rng = random.Random(1)
    long = "".join(rng.choice("abc") for _ in range(30_000))
    other = long[:20_000] + ("a" if long[20_000] != "a" else "b") + long[20_001:]
    rows = [(i, f"{long} " * 5 + long[:-1]) for i in range(5)] + [(9, f"{other} " * 5)]
    found = {w: (len(form or ""), len(root), near) for w, form, root, _, near, _ in found_variants(docs_of(rows))}
    assert found[other] == (30_000, 30_000, 1)
    assert found[long][2] == 2 and found[long[:-1]][:2] == (30_000, 30_000)


def test_variants_of_no_words(spark, docs_of):
    assert found_variants(docs_of([])) == [] == found_variants(docs_of([(1, None), (2, "123 short")]))
    assert found_variants(docs_of([(1, "lonely lonely")] * 3)) == [("lonely", None, "lonely", 6, 0, None)]
    with pytest.raises(ValueError, match="above 1"):
        spelling_variants(docs_of([]), times=1)
