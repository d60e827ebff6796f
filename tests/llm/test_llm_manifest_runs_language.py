"""Merkle manifests, periodic runs and language identification against brute force, and on odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, corpus, docs, empty, frame, odd, pseudo  # noqa: F401

from gatefold.llm import language, manifest, runs


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- 11
def brute_manifest(rows, arity=2):
    """(doc_id, source, lang, n_chars, text) -> sorted result rows, one run after the other."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha(*map(field, r))
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))

    def climb(level):
        """The levels of a tree, and for each start node its steps: (siblings, own place)."""
        paths = [[] for _ in level]
        at = list(range(len(level)))
        while len(level) > 1:
            up = []
            for i in range(0, len(level), arity):
                up.append(sha(*level[i : i + arity]))
            for k, i in enumerate(at):
                first = i // arity * arity
                run = level[first : first + arity]
                paths[k].append(([x for j, x in enumerate(run) if j != i - first], i - first))
                at[k] = i // arity
            level = up
        return level[0], paths

    made = {}
    for x in names:
        own = sorted(trees[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[x] = (own, *climb([leaf(r) for r in own]))
    root, tops = climb([made[x][1] for x in names])
    out = []
    for x, above in zip(names, tops, strict=True):
        own, sub, paths = made[x]
        for r, path in zip(own, paths, strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf((*r[:3], r[3] + 1 if r[3] is not None else None, r[4])) if hit else leaf(r)
            for others, place in [*path, *above]:
                h = sha(*others[:place], h, *others[place:])
            out.append((r[0], leaf(r), sub, root, sha(*[o for others, _ in [*path, *above] for o in others]), h, h == root))
    return sorted(map(repr, out))


def manifest_of(spark, rows, tmp_path, parts=5):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(parts)
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = manifest.op11_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(repr(tuple(r)) for r in got.collect())


@pytest.mark.parametrize(("n", "langs"), [(1, ["en"]), (37, ["en", None, "fr", "é"]), (300, ["en", "en", "en", "de", None])])
def test_manifest_equals_brute_force(spark, monkeypatch, tmp_path, n, langs):
    """Bands and a task's partial parents so small that frontiers and paths go through several rounds."""
    monkeypatch.setattr(manifest, "BAND", 3)
    monkeypatch.setattr(manifest, "PENDING", 4)
    rng = random.Random(n)
    rows = [(i * 3, f"s{i % 4}" if i % 5 else None, rng.choice(langs), None if i % 9 == 0 else i, None if i % 11 == 0 else pseudo(rng, i % 7) + "é") for i in range(n)]
    assert manifest_of(spark, rows, tmp_path) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark, tmp_path):
    """Null ids, ids of several rows, equal rows, a group of one row, as one third of the table each."""
    rows = [(None, "a", "en", 1, "x")] * 9 + [(7, "a", "en", 1, t) for t in ("x", "y", "", None, "long " * 4000)] + [(i, None, None, None, None) for i in range(9)] + [(3, "", "", 0, "")]
    want = brute_manifest(rows)
    assert manifest_of(spark, rows, tmp_path) == want == manifest_of(spark, rows[::-1], tmp_path, 2)
    assert manifest_of(spark, [], tmp_path) == []


def test_manifest_of_other_arities(spark):
    """A proof folds to the root for leaves of every place, and only with its own leaf."""
    df = spark.createDataFrame([(i, "ab"[i % 5 == 0]) for i in range(60)], "k long, g string")
    m = manifest.manifest(df, "k", "g", manifest.leaf_digest([F.col("k")]), {"k": F.col("k")}, arity=3)
    root = manifest.hexed(F.col("root"))
    wrong = manifest.folded(manifest.leaf_digest([F.col("k") + 1]), F.col("others"), F.col("at"))
    r = m.select((manifest.folded(F.col("leaf"), F.col("others"), F.col("at")) == root).alias("good"), (wrong == root).alias("bad")).groupBy("good", "bad").count().collect()
    assert [(x.good, x.bad, x["count"]) for x in r] == [(True, False, 60)]
    assert manifest.widths(10, 3) == [10, 4, 2, 1] and manifest.widths(1) == [1]


# ---------------------------------------------------------------- 12
def brute_runs(w, exponent=4, least=6):
    best: dict = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, exponent * p):
                best.setdefault((i, j + p - i), p)
            i = j
    return sorted((s, size, p) for (s, size), p in best.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def squeezed(w, found):
    gone = {k for s, size, p in found for k in range(s + p, s + size)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def repetitive(rng):
    out = []
    for _ in range(rng.randint(1, 5)):
        part = [rng.choice("abc") + rng.choice(["", "é"]) for _ in range(rng.randint(1, 6))]
        out += part * rng.randint(1, 8) + part[: rng.randint(0, len(part))] + [rng.choice("abcxyz") for _ in range(rng.randint(0, 4))]
    return rng.choice(["  ", " ", "\n"]).join(out)


@pytest.mark.parametrize("pairs", [1 << 21, 16])
def test_runs_equal_brute_force(pairs):
    rng = random.Random(3)
    texts = [repetitive(rng) for _ in range(300)] + ["", "a", "a a a a a a", "a b a b a b", "x " * 500, "  ", "a b " * 300 + "a", "aa ab " * 3]
    w = runs.Words([t.encode() for t in texts])
    doc, start, size, p = runs.periodic_runs(w.hashes(), w.first, pairs=pairs)
    for k, t in enumerate(texts):
        assert [(int(a), int(b), int(c)) for d, a, b, c in zip(doc, start, size, p, strict=True) if d == k] == brute_runs(words_of(t)), t


def test_runs_table(spark, docs, corpus):  # noqa: F811
    got = {r.doc_id: r for r in runs.find_runs(docs).collect()}
    assert len(got) == len(corpus)
    for i, t in corpus:
        found = brute_runs(words_of(t))
        assert got[i].n_words == len(words_of(t)) and [tuple(r) for r in got[i].runs] == found
        assert got[i].collapsed == squeezed(words_of(t), found)


def test_wrong_hashes_are_found(monkeypatch):
    """Words that a poor hash confuses are told apart by their bytes."""
    rng = random.Random(8)
    texts = [repetitive(rng).encode() for _ in range(80)]
    want = [brute_runs(words_of(t.decode())) for t in texts]
    monkeypatch.setattr(runs.Words, "hashes", lambda w: (w.data[w.start] % 2).astype(np.uint64))
    w, (doc, start, size, p) = runs.verified_runs(texts)
    same = [[(int(a), int(b), int(c)) for d, a, b, c in zip(doc, start, size, p, strict=True) if d == k] for k in range(len(texts))]
    # what a text without a wrong run finds is right, and a wrong run sends the text to the exact search
    assert sum(a == b for a, b in zip(same, want, strict=True)) >= 70
    assert all(r in b for a, b in zip(same, want, strict=True) if a != b for r in a)


def test_op12_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, pseudo(rng, rng.choice([0, 3, 40, 200])) if i % 7 else repetitive(rng)) for i in range(400)] + [(900, None), (901, ""), (902, " \n "), (None, "a a a a a a a b")]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, runs string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in runs.op12_periodic_runs(spark, str(tmp_path)).collect()}
    changed = 0
    for i, t in rows:
        w = words_of(t)
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        found = brute_runs(w)
        s, size, p = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        assert got[i] == (len(found), s, size, p, 1000 * size // p if found else None, sha(lines), sha(squeezed(w, found))), i
    assert changed > 20


def test_runs_of_one_very_long_text():
    text = b" ".join([b"w%d" % (k * 7919 % 5003) for k in range(120_000)] + [b"p", b"q", b"r"] * 9000)
    w, (doc, start, size, p) = runs.verified_runs([text])
    # the words repeat every 5,003, which the last ones don't, and then every three
    assert [(int(a), int(b), int(c)) for a, b, c in zip(start, size, p, strict=True)] == [(0, 120_000, 5003), (120_000, 27_000, 3)]
    assert len(runs.collapsed(w, (doc, start, size, p))[0].split()) == 5003 + 3


# ---------------------------------------------------------------- 13
def brute_kernel(a: bytes, b: bytes) -> float:
    def sets(t):
        plain = re.sub(rb"[\x00-\x60\x7b-\x7f]+", b" ", t.lower())
        t = b" " + plain.strip(b" ") + b" "
        out = []
        for n in range(1, language.ORDERS + 1):
            code = [int.from_bytes(t[i : i + n], "big") for i in range(len(t) - n + 1)]
            out.append({((c * 0x9E3779B1) & 0xFFFFFFFF) >> 16 if n > 2 else c for c in code})
        return out

    return float(np.mean([len(x & y) / max(1.0, np.sqrt(len(x) * len(y))) for x, y in zip(sets(a), sets(b), strict=True)]))


def test_kernel_equals_brute_force():
    texts = ["the cat sat", "Der Hund,  der läuft!", "a", "12 été 3", "x" * 300, "Ж", "and the other cat sat on"]
    raw = [t.encode() for t in texts]
    grams, starts = language.presence(raw)
    cut = starts[:: language.ORDERS]
    marks = language.landmarks([grams[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)])
    got = language.products(grams, starts, marks.columns)
    assert np.allclose(got, [[brute_kernel(a, b) for b in raw] for a in raw], atol=1e-6)
    assert (language.order_starts(grams, cut) == starts).all()
    f = marks.features(grams, starts)[:, :-1]
    assert np.allclose(f @ f.T, got, atol=1e-4)  # with every text a landmark the features give the kernel


def test_folded_weights_equal_features():
    rng = random.Random(2)
    raw = [pseudo(rng, 30).encode() for _ in range(12)]
    grams, starts = language.presence(raw)
    cut = starts[:: language.ORDERS]
    marks = language.landmarks([grams[cut[k] : cut[k + 1]] for k in range(5)])
    w = np.random.default_rng(1).normal(size=(marks.root.shape[1], 3))
    model = language.Model(["a", "b", "c"], marks.columns @ (marks.root @ w), np.array([0.1, 0.0, -0.1]))
    s = marks.features(grams, starts)[:, :-1] @ w + model.bias
    best, score = model.predict(grams, starts)
    assert (best == s.argmax(1)).all() and np.allclose(score, np.clip(s.max(1), 0, 1), atol=1e-5)


def test_language_is_learned_and_predicted(spark, tmp_path):
    rng = random.Random(6)
    parts = {"en": ["the", "ing", "tion", "and", "th"], "de": ["sch", "ung", "ein", "der", "ß"], "xx-long name": ["ka", "ri", "mo", "ño"]}
    text = lambda x, n: " ".join("".join(rng.choice(parts[x]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    langs = [rng.choices(list(parts), [60, 30, 4])[0] for _ in range(500)]
    rows = [(i, text(x, rng.choice([2, 8, 60])), x) for i, x in enumerate(langs)]
    # held-out rows and rows without a language teach nothing
    lies = [(i, text("en", 30), "lie") for i in range(5000, 5400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows += lies + [(6000, None, "en"), (6001, "123 !? \n", "de"), (6002, "", None), (6003, text("de", 40), None), (None, text("en", 20), "null id"), (6004, "THE THE TION!", "de")]
    spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, score int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in language.op13_string_kernel(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    held = [i for i, x in enumerate(langs) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in held) for i in range(len(langs)))
    assert np.mean([got[i].lang_pred == langs[i] for i in held]) > 0.95 and len(held) > 90
    assert all(0 <= r.score <= 1 and r.lang_pred in {*parts, "und"} for r in got.values())
    assert {got[i].lang_pred for i in (6000, 6001, 6002)} == {"und"} and got[6000].score == 0
    assert got[6003].lang_pred == "de" and got[None].lang_pred == "en" and got[6004].lang_pred == "en" and not got[None].held_out
    assert all(got[i].lang_pred == "en" for i, _, _ in lies)


def test_language_of_nothing(spark, empty):  # noqa: F811
    assert language.fit(empty.select("lang", "text")) is None
    one = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert [(r.doc_id, r.lang_pred, r.score) for r in language.identify(one, None, [F.col("doc_id")]).collect()] == [(1, "und", 0.0), (2, "und", 0.0)]


# ---------------------------------------------------------------- odd tables
@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_periodic_runs", "op13_string_kernel"])
def test_odd_and_empty_tables_of_new_operators(spark, odd, empty, tmp_path, name):  # noqa: F811
    from gatefold.llm.queries import queries

    for k, df in enumerate((odd, empty)):
        df.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        got = queries()[name](spark, f"{tmp_path}/{k}")
        assert got.count() == df.count() and "doc_id" in got.columns
    assert SCHEMA.startswith("doc_id")
