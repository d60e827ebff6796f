"""The training-data operators against brute force, round trips and odd inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, pos int, rep int, key string, w int, topic string, p double, kept boolean, _row string, n_tokens int, h1 int, _gone string"
EXTRA = ("x", 1, 2, "k", 3, "t", 0.5, True, "r", 9, 4, "g")


def pseudo(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(2 + k % 5)) if k % 3 else "the" for k in (rng.randrange(vocabulary) for _ in range(n)))


@pytest.fixture(scope="module")
def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared lines and passages, empty, null and long texts."""
    rng = random.Random(5)
    base = [pseudo(rng, rng.choice([3, 12, 60, 150, 400])) for _ in range(40)]
    texts: list[str | None] = [*base, *base[:6], None, "", "   ", "one", "Zwölf Ümlaute ß " * 30, "a" * 5000, "x\n" * 400]
    for b in base[:12]:
        w = b.split()
        if len(w) > 50:
            w[len(w) // 2] = "changed"
            texts.append(" ".join(w))
            texts.append(" ".join(w[:-1]))
    passage = pseudo(rng, 160)
    for b in base[12:18]:
        texts.append(f"{b}\n{passage}\nA Shared Line Of Text\n{b[::-1]}")
    texts.append("\n".join(pseudo(rng, 12) for _ in range(2000)))
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows, langs=("en", "fr", None)):
    data = [(i, t, langs[k % len(langs)], None if k % 11 == 0 else f"src{k % 3}", len(t or ""), *EXTRA) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return frame(spark, corpus).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, ties, nulls everywhere, clashing names."""
    return frame(spark, [(None, "null id text with enough words to count here twice"), (None, None), (1, "repeated row " * 60), (1, "repeated row " * 60), (2, ""), (3, "repeated row " * 60), (4, "\n\n"), (5, "é" * 900)])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- 1
def shingles(text, size):
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans(up, up.lower())))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute_components(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return {rows[i][0]: (len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs, corpus, size, percent):
    from gatefold.llm.near_dedup import near_duplicates

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, size, percent).collect()}
    assert got == brute_components(corpus, size, percent)


def test_near_duplicates_branch_large_nodes(spark, monkeypatch):
    """Nodes over the limit are branched, and what stays large is still compared in blocks."""
    from gatefold.llm import near_dedup

    monkeypatch.setattr(near_dedup, "LIMIT", 8)
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    rng = random.Random(3)
    base = pseudo(rng, 120).split()
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, pseudo(rng, 80)) for i in range(10)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == brute_components(rows, 3, 85)


@pytest.mark.parametrize(("block", "shingles"), [(4, 10**6), (1000, 500)])
def test_near_duplicates_of_wide_components(spark, monkeypatch, block, shingles):
    """Components of many blocks: chains that link block by block, and large and small classes that stay apart."""
    from gatefold.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SHINGLES", shingles)
    monkeypatch.setattr(near_dedup, "agreement", lambda percent: 20)  # candidates far below the threshold
    rng = random.Random(8)
    base = pseudo(rng, 120).split()
    rows = []
    for g in range(5):  # groups of one origin, too far apart to be linked
        own = [w if rng.random() < 0.9 else f"g{g}" for w in base]
        for i in range((30, 14, 3, 1, 9)[g]):
            if g == 1:  # a chain: only neighbours are linked
                own[7 * i : 7 * i + 4] = [f"c{i}x{k}" for k in range(4)]
            w = list(own)
            if g != 1:
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append((100 * g + 7 * i % 83, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    want = brute_components(sorted(rows), 3, 85)
    assert got == want and len({c for _, c in want.values()}) >= 5


def test_trees_follow_the_recall():
    from gatefold.llm.near_dedup import DEPTH, n_trees

    for percent in (80, 85, 95):
        n = n_trees(percent, 0.99)
        miss = lambda t: (1 - (percent / 100) ** DEPTH) ** t  # noqa: B023, E731
        assert miss(n) <= 0.01 < miss(n - 1)


def test_near_duplicates_branch_more_large_nodes_than_are_broadcast(spark, monkeypatch):
    """Nodes over the limit beyond the HOT_NODES largest of a pass are branched too."""
    from gatefold.llm import near_dedup

    monkeypatch.setattr(near_dedup, "LIMIT", 8)
    monkeypatch.setattr(near_dedup, "HOT_NODES", 1)
    rng = random.Random(4)
    rows = []
    for g in range(4):
        base = pseudo(rng, 120).split()
        for i in range(20):
            w = list(base)
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append((100 * g + i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_components_of_a_path_and_a_star(spark):
    from gatefold.llm.graph import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 199), (199, 300), (5, 5)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {200: 199, 300: 199}


# ---------------------------------------------------------------- 2
def plain_reader(d: bytes) -> tuple[list[bytes], int]:
    """A second, plain reader of the files written here: frames of unlaced and fixed-size, Xiph or EBML laced blocks, and clusters."""

    def number(at, keep=False):
        n = 9 - d[at].bit_length()
        v = int.from_bytes(d[at : at + n], "big")
        return (v if keep else v & ((1 << (7 * n)) - 1)), at + n, n

    frames, clusters = [], 0

    def block(at, end):
        _, at, _ = number(at)
        flags, at = d[at + 2], at + 3
        lacing = flags >> 1 & 3
        if not lacing:
            frames.append(d[at:end])
            return
        n, at = d[at] + 1, at + 1
        sizes = []
        if lacing == 2:
            sizes = [(end - at) // n] * n
        elif lacing == 1:
            for _ in range(n - 1):
                size = 0
                while d[at] == 255:
                    size, at = size + 255, at + 1
                sizes.append(size + d[at])
                at += 1
        else:
            for k in range(n - 1):
                v, at, w = number(at)
                sizes.append(v if k == 0 else sizes[-1] + v - ((1 << (7 * w - 1)) - 1))
        if lacing != 2:
            sizes.append(end - at - sum(sizes))
        for x in sizes:
            frames.append(d[at : at + x])
            at += x

    def walk(at, end):
        nonlocal clusters
        while at < end:
            name, at, _ = number(at, True)
            size, at, _ = number(at)
            if name in (0x18538067, 0x1F43B675, 0xA0):
                clusters += name == 0x1F43B675
                walk(at, at + size)
            elif name in (0xA3, 0xA1):
                block(at, at + size)
            at += size

    walk(0, len(d))
    return frames, clusters


def test_media_round_trip(docs, corpus):
    from gatefold.llm.matroska import media_round_trip, text_media

    media = {r[0]: bytes(r[1]) for r in text_media(docs).collect()}
    got = {r.doc_id: r for r in media_round_trip(docs).collect()}
    for i, t in corpus:
        raw = (t or "").encode()
        full = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
        packets, clusters = plain_reader(media[i])
        assert (r.media_bytes, r.media_sha256) == (len(media[i]), hashlib.sha256(media[i]).hexdigest()) and b"".join(packets) == full
        x = [b for b in full]
        flips = sum((a >= 128) != (b >= 128) for a, b in itertools.pairwise(x))
        assert f"clusters={clusters};" in r.feature and f"packets={len(packets)};" in r.feature
        assert r.feature.endswith(f"sum={sum(x)};energy={sum(b * b for b in x)};flips={flips}")


@pytest.mark.parametrize("kind", ["xiph", "ebml", "fixed"])
def test_lacings(kind):
    from gatefold.llm import matroska as m

    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 9)
        sizes = [rng.choice([0, 1, 254, 255, 256, 700])] * n if kind == "fixed" else [rng.choice([0, 1, 254, 255, 256, 700, 20_000]) for _ in range(n)]
        frames = [rng.randbytes(s) for s in sizes]
        d = m.HEAD + m.element(m.SEGMENT, m.TRACK_BODY + m.element(m.CLUSTER, m.unsigned(m.TIME, 7) + m.block(1, 3, frames, kind, simple=rng.random() < 0.5)))
        p = m.parse(d).packets
        assert [d[o : o + s] for _, _, o, s, _, _ in p] == frames
        assert p[0][1] == 10_000_000


def test_unknown_sizes_and_damage():
    from gatefold.llm import matroska as m

    d = m.HEAD + m.ebml_id(m.SEGMENT) + b"\x01" + b"\xff" * 7 + m.TRACK_BODY + m.ebml_id(m.CLUSTER) + b"\xff" + m.unsigned(m.TIME, 5) + m.block(1, 0, [b"abc"], "none") + m.element(m.CLUSTER, m.block(1, 2, [b"de"], "none", key=False, simple=False))
    assert [(p[3], p[4], p[5]) for p in m.parse(d).packets] == [(3, True, 0), (2, False, 1)]
    for bad in (b"", b"RIFF1234", m.write(b" " * 192)[:-40]):
        with pytest.raises(m.MediaError):
            m.parse(bad)


def test_packet_table(spark):
    from gatefold.llm import matroska as m

    df = spark.createDataFrame([(1, m.write(b"ab" * 960)), (2, None), (3, b"nonsense")], "id long, media binary")
    rows = m.packet_table(df, "id", "media").collect()
    assert [r.size for r in rows if r.key == 1] == [192] * 10
    assert [r.timestamp_ns for r in rows if r.key == 1][:2] == [0, 4_000_000]
    assert [bool(r.error) for r in rows if r.key == 3] == [True]
    assert not [r for r in rows if r.key == 2]


# ---------------------------------------------------------------- 3
def brute_lines(rows):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held: dict[str, set] = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(held[key(x)]) > 1 and min(held[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup_equals_brute_force(docs, corpus):
    from gatefold.llm.line_dedup import line_dedup

    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in line_dedup(docs, stats=True).collect()}
    assert got == brute_lines(corpus)


# ---------------------------------------------------------------- 4
def cheapest(roles, chat):
    best = [10**9]

    def go(i, state, cost, inserted):
        if cost >= best[0]:
            return
        if i == len(roles) and state == chat.FINAL:
            best[0] = cost
        if i < len(roles):
            for to in chat.ROLES:
                c = chat.relabel_cost(roles[i], to)
                if to in chat.NEXT[state]:
                    go(i + 1, to, cost + c, 0)
                if to == state:
                    go(i + 1, state, cost + c + chat.MERGE, 0)
        if inserted < 4:
            for to in chat.NEXT[state]:
                go(i, to, cost + chat.INSERT, inserted + 1)

    go(0, None, 0, 0)
    return best[0]


def test_role_repair_is_cheapest():
    from gatefold.llm import chat

    for n in range(1, 4):
        for roles in itertools.product((*chat.ROLES, None), repeat=n):
            cost, out = chat.repair([(r, str(k)) for k, r in enumerate(roles)])
            assert chat.legal([r for r, _, _ in out])
            assert "".join(t.replace(chat.GLUE, "") for _, t, _ in out) == "".join(map(str, range(n)))
            assert cost == cheapest(roles, chat), roles


def shortest(roles, chat):
    """The least cost by Dijkstra's search over (turns taken, last role)."""
    import heapq

    todo, done = [(0, 0, "", None)], set()
    while todo:
        cost, i, _, state = heapq.heappop(todo)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(roles) and state == chat.FINAL:
            return cost
        for to in chat.ROLES:
            if to in chat.NEXT[state]:
                heapq.heappush(todo, (cost + chat.INSERT, i, to, to))
            if i < len(roles):
                c = chat.relabel_cost(roles[i], to)
                if to in chat.NEXT[state]:
                    heapq.heappush(todo, (cost + c, i + 1, to, to))
                if to == state:
                    heapq.heappush(todo, (cost + c + chat.MERGE, i + 1, to, to))


def test_longer_role_repairs_are_cheapest():
    """Random conversations of 4 to 8 turns: the least cost, which the returned turns have, and their rendered text."""
    from gatefold.llm import chat

    rng = random.Random(14)
    for _ in range(1500):
        roles = [rng.choice((*chat.ROLES, None, "bot")) for _ in range(rng.randint(4, 8))]
        cost, out = chat.repair([(r, f"<{k}>") for k, r in enumerate(roles)])
        assert cost == shortest(roles, chat), roles
        assert chat.legal([r for r, _, _ in out])
        paid, taken = 0, []
        for role, text, how in out:
            own = [int(k) for k in re.findall(r"<(\d+)>", text)]
            paid += chat.INSERT if how == "insert" else chat.MERGE * (len(own) - 1) + sum(chat.relabel_cost(roles[k], role) for k in own)
            taken += own
        assert paid == cost and taken == list(range(len(roles)))
        turns = re.findall(re.escape(chat.OPEN) + r"(\w+)\n(.*?)" + re.escape(chat.CLOSE), chat.render(out), re.S)
        assert turns == [(r, t) for r, t, _ in out]


def test_role_repair_of_odd_tables(spark):
    """Nothing, clashing extra columns, long texts, and turns without a conversation, each of which stands alone."""
    from gatefold.llm.chat import repair_conversations

    schema = "conv_id long, turn int, role string, text string, s string, t int, r string, x string, n_turns long, cost long, rendered string"
    assert repair_conversations(spark.createDataFrame([], schema)).count() == 0
    extra = ("s", 1, "r", "x", 7, 8, "z")
    long_text = "word " * 300_000
    rows = [(1, 1, "assistant", long_text, *extra), (1, 0, "user", None, *extra), (1, 0, "user", None, *extra), *[(None, k % 3, "user", f"alone {k}", *extra) for k in range(50)], (None, None, None, None, *extra), (None, None, None, None, *extra)]
    out = repair_conversations(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 53 and sum(r.conv_id is None for r in out) == 52 and {r.n_turns for r in out if r.conv_id is None} == {1}
    one = next(r for r in out if r.conv_id == 1)
    assert one.n_turns == 3 and one.n_merged == 1 and long_text in one.rendered


def test_role_repair_table(spark):
    from gatefold.llm.chat import repair_conversations

    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 1, "assistant", "b"), (2, 0, None, None), (None, 0, "tool", "<|im_end|>"), (3, None, "user", "a"), (3, None, "user", "a")]
    got = {r.conv_id: r for r in repair_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert got[1].was_legal and got[1].cost == 0
    assert got[1].rendered == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert got[2].roles == "user,assistant" and got[2].n_relabeled == 1
    assert "< |im_end|>" in got[None].rendered
    assert got[3].n_merged == 1


# ---------------------------------------------------------------- 5
def brute_base(text):
    s = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", s)
    seen, dup = set(), 0
    for line in s.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {k for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in s), dup, len(cover)


def test_base_counts_equal_brute_force(corpus):
    from gatefold.llm.quality import COUNTS, base_counts

    texts = [t for _, t in corpus] + ["a b c d e\na b c d e\n#x <y>", "same\nsame\n \n \nsame"]
    got = base_counts([(t or "").encode() for t in texts])
    for k, t in enumerate(texts):
        assert tuple(int(got[c][k]) for c in COUNTS) == brute_base(t)


def test_kneser_ney_sums_to_one_and_backs_off():
    from gatefold.llm.quality import BITS, ORDER, codes_of, kneser_ney, score

    rng = random.Random(2)
    code, at = codes_of([pseudo(rng, 500).encode() for _ in range(6)])
    u, n = np.unique(code, return_counts=True)
    levels = kneser_ney(u, n)
    ctx = np.unique(u >> BITS)[:20]
    every = ((ctx[:, None] << BITS) | np.arange(1 << BITS)).ravel()
    total = np.exp(score(levels, every)).reshape(len(ctx), -1).sum(1)
    assert np.allclose(total, 1, atol=1e-9)
    assert np.allclose(score(levels, u), levels[-1].logp[np.searchsorted(levels[-1].codes, u)], atol=1e-6)
    assert len(levels) == ORDER and at[-1] == len(code)


def brute_counts(seqs, order):
    top: Counter = Counter()
    for q in seqs:
        padded = [0] * (order - 1) + q
        top.update(tuple(padded[i : i + order]) for i in range(len(q)))
    return top


def brute_model(top, order):
    """Interpolated modified Kneser-Ney over symbol sequences with dictionaries: (history, symbol) -> probability."""
    tables = {order: dict(top)}
    for k in range(order - 1, 0, -1):
        lower: Counter = Counter(g[1:] for g in tables[k + 1])
        tables[k] = dict(lower)

    def cut(table):
        t = [sum(1 for n in table.values() if n == k) for k in (1, 2, 3, 4)]
        if min(t[:3]) == 0:
            return [0, 0.75, 0.75, 0.75]
        y = t[0] / (t[0] + 2 * t[1])
        d = [1 - 2 * y * t[1] / t[0], 2 - 3 * y * t[2] / t[1], 3 - 4 * y * t[3] / t[2]]
        return [0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))]

    total, left, cuts = {}, {}, {}
    for k, table in tables.items():
        d = cuts[k] = cut(table)
        for g, n in table.items():
            total[g[:-1], k] = total.get((g[:-1], k), 0) + n
            left[g[:-1], k] = left.get((g[:-1], k), 0) + d[min(n, 3)]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 32
        if (g[:-1], k) not in total:
            return p(g[1:])
        n = tables[k].get(g, 0)
        return (n - cuts[k][min(n, 3)]) / total[g[:-1], k] + left[g[:-1], k] / total[g[:-1], k] * p(g[1:])

    return p


@pytest.mark.parametrize(("limit", "prior"), [(1 << 28, 1 << 17), (1, 3000)])
def test_quality_equals_brute_force(spark, monkeypatch, limit, prior):
    """Perplexity and verdict of every document, with small languages, in one group of languages and in several, with a full and a scaled prior."""
    from gatefold.llm import quality as q

    monkeypatch.setattr(q.groups_of, "__defaults__", (limit,))
    monkeypatch.setattr(q.with_prior, "__defaults__", (prior,))
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice(["Ther", "ing", "and", "über", "est.", "5x"]) + rng.choice(["a", "o", "", "ly"]) for _ in range(n))
    rows = [(i, text(rng.choice([5, 15, 40, 90])), "en" if i % 3 else "de", "s") for i in range(160)]
    rows += [(300, "x" * 400 + " a" * 40, "en", "s"), (301, "| ".join("qzxj" * 3 for _ in range(30)), "en", "s"), (400, text(30), "pt", "s"), (401, text(60), None, "s"), (402, None, "en", "s"), (404, "LOUD WORDS " * 20, "it", "s")]
    rows.append((403, " ".join(f"{rng.choice('bcdfg')}{k}#&" for k in range(80)), "en", "s"))
    got = {r.doc_id: r for r in q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    name = lambda x: x or "xx"
    whole = {i: t or "" for i, t, _, _ in rows}
    seq = {i: [int(q.CLASS[c]) for c in t.encode() if c < 0xC0] for i, t in whole.items()}

    def teaches(t):
        letters, big = len(re.findall("[A-Za-z]", t)), len(re.findall("[A-Z]", t))
        return len(t.split()) >= 10 and 10 * len(re.findall(r"[#*$%&|<>]", t)) <= len(t.split()) and big <= 0.3 * letters

    langs = sorted({name(x) for _, _, x, _ in rows})
    own = {x: [i for i, _, y, _ in rows if name(y) == x] for x in langs}
    counts = {x: brute_counts([seq[i] for i in own[x] if teaches(whole[i])], q.ORDER) for x in langs}
    pooled: Counter = sum(counts.values(), Counter())
    share = min(1.0, prior / sum(pooled.values()))
    mean = {}
    for lang in langs:
        top = Counter(counts[lang])
        top.update({g: k for g, n in pooled.items() if (k := int(np.floor(n * share + 0.5)))})
        p = brute_model(top, q.ORDER)
        for i in own[lang]:
            padded = [0] * (q.ORDER - 1) + seq[i]
            if whole[i].split():
                mean[i] = -sum(np.log(p(tuple(padded[k : k + q.ORDER]))) for k in range(len(seq[i]))) / len(seq[i])
    assert not teaches(whole[404]) and not teaches(whole[403])
    for i, m in mean.items():
        assert np.log(got[i].perplexity) == pytest.approx(m, abs=5e-5)
    at = lambda v, width, share: (sorted(int(np.floor(max(-64, min(64, x)) / width)) for x in v)[int(np.ceil(share * len(v))) - 1] + 0.5) * width
    fine = {x: [i for i in own[x] if i in mean and not got[i].base_failed] for x in langs}
    fine[""] = [i for x in langs for i in fine[x]]
    shrunk = lambda n, a, b: (n * a + q.SHRINK * b) / (n + q.SHRINK)
    raw = {x: at([round(mean[i], 6) for i in v], 0.005, 0.5) for x, v in fine.items() if v}
    mid = {x: shrunk(len(fine[x]), raw[x], raw[""]) for x in raw}

    def scatter(x):
        dev = [(round(mean[i], 6) - mid[x]) * np.sqrt(len(seq[i])) for i in fine[x]]
        return (at(dev, 0.05, 0.75) - at(dev, 0.05, 0.25)) / 1.349

    checked = 0
    for x in langs:
        for i in fine[x]:
            n = len(fine[x])
            a = shrunk(n, scatter(x), scatter(""))
            z = (mean[i] - mid[x]) / (1 + 10 / n) / np.sqrt(a * a / len(seq[i]) + (q.FLOOR * mid[x]) ** 2)
            if min(abs(z + q.LOW), abs(z - q.HIGH)) > 0.05:
                checked += 1
                assert got[i].kept == (-q.LOW <= z <= q.HIGH), (i, z)
    assert checked > 100
    assert not got[300].kept and not got[403].kept and not got[402].kept and got[402].perplexity is None
    assert sum(got[i].kept for i in range(160)) > 0.95 * sum(not got[i].base_failed for i in range(160))


def test_quality_rejects_noise_and_keeps_prose(spark):
    from gatefold.llm.quality import judge

    rng = random.Random(9)
    prose = lambda: " ".join("".join(rng.choice(("ther", "ing", "and", "over", "est")) for _ in range(rng.randint(1, 3))) for _ in range(200))
    noise = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(120))
    rows = [(i, prose(), "en", "s") for i in range(120)] + [(500 + i, noise(), "en", "s") for i in range(3)]
    rows += [(600, "too short", "en", "s"), (601, None, None, None)]
    got = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i].kept for i in range(120))
    assert not any(got[500 + i].kept for i in range(3)) and not got[500].base_failed
    assert got[600].base_failed and got[601].base_failed and not got[601].kept


# ---------------------------------------------------------------- 6
def test_rans_blocks_round_trip():
    from gatefold.llm import rans_ids as r

    rng = np.random.default_rng(4)
    for n in (1, 31, 32, 33, r.BLOCK - 1, r.BLOCK, r.BLOCK + 1, 3 * r.BLOCK + 7):
        ids = rng.zipf(1.3, n) % 40_000
        s = r.Segment(r.write_segment(ids.astype(np.uint32), [None, 7], np.array([1, n - 1])))
        assert (s.ids() == ids).all() and s.doc_ids == [None, 7]
        assert (s.blocks([s.n_blocks - 1]) == ids[(s.n_blocks - 1) * r.BLOCK :]).all()


def test_rans_damage_is_found():
    from gatefold.llm import rans_ids as r

    good = r.write_segment(np.arange(5000, dtype=np.uint32) % 77, [1], np.array([5000]))
    for at in (3, 30, len(good) - 5):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(r.CorruptBlock):
            r.Segment(bytes(bad)).ids()


def test_rans_table_equals_library(docs, corpus):
    from gatefold.llm import rans_ids as r
    from gatefold.llm.common import stored

    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(r.default_path())
    added = [(500, "end <|endoftext|> here"), (501, "A<|startoftext|>b <|ENDOFTEXT|>"), (502, "<|endof text|>"), (503, "<|endoftext|>")]
    more = docs.unionByName(frame(docs.sparkSession, added))
    got = {x.doc_id: x for x in r.read_documents(stored(r.encode_documents(more, parts=3), "t")).collect()}
    at = 0
    for i, t in [*corpus, *added]:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# ---------------------------------------------------------------- 7
def test_bpe_equals_library(corpus):
    import public_tokenizers
    import tiktoken

    from gatefold.llm.byte_bpe import ByteBPE, default_path

    own = ByteBPE(default_path())
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(6)
    texts = [t or "" for _, t in corpus] + ["".join(rng.choice("ab \n\té́ß中\U0001f600'sT.,!0\r") for _ in range(rng.randint(0, 50))) for _ in range(500)] + ["ab" * 3000]
    ids = own.encode(texts)
    assert ids == [lib.encode_ordinary(t) for t in texts]
    assert [own.decode(x).decode() for x in ids] == texts


def test_bpe_tables(docs, corpus):
    from gatefold.llm.byte_bpe import decode_documents, encode_documents, round_trip

    back = {r.doc_id: r.data.decode() for r in decode_documents(encode_documents(docs)).collect()}
    assert back == {i: t or "" for i, t in corpus}
    sha = {r.doc_id: r.decoded_sha256 for r in round_trip(docs).collect()}
    assert sha == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in corpus}


# ---------------------------------------------------------------- 8
def brute_cut(texts, length):
    raw = [(t or "").encode() for t in texts]
    c = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        m = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if c[b[i : i + length]] > 1:
                m[i] += 1
                m[i + length] -= 1
        hit = np.cumsum(m)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~hit].tobytes()
        out.append((len(b), int(hit.sum()), int((np.diff(hit.astype(int), prepend=0) == 1).sum()), kept))
    return out


@pytest.mark.parametrize(("length", "gram"), [(400, 64), (60, 16)])
def test_suffix_dedup_equals_brute_force(docs, corpus, length, gram):
    from gatefold.llm.suffix_dedup import cut_repeats

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in cut_repeats(docs, length, gram).collect()}
    want = brute_cut([t for _, t in corpus], length)
    assert [got[i] for i, _ in corpus] == want


def test_suffix_sort_orders_suffixes():
    from gatefold.llm.suffix_dedup import Suffixes

    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at = rng.permutation(2000)[:301]
    n = len(at)
    s = Suffixes(data, 50).sort(at, np.zeros(n, np.int64), np.full(n, n))
    assert sorted(at.tolist()) == sorted(s.tolist())
    keys = [data[i : i + 50].tobytes() for i in s]
    assert keys == sorted(keys)


def test_long_texts_come_in_pieces(monkeypatch):
    from gatefold.llm import suffix_dedup as s

    rng = random.Random(8)
    t = rng.randbytes(30_000)
    whole = s.anchors([t])
    monkeypatch.setattr(s, "PIECE", 5000)
    parts = s.anchors([t])
    windows = lambda a: {int(w) for x, y in zip(a[1], a[2], strict=True) for w in range(x, y + 1)}
    assert windows(whole) == windows(parts) == set(range(30_000 - 399))


def test_passages_of_very_many_contexts(spark, monkeypatch):
    """An anchor of more contexts than a task may get is split by the bytes its windows share, down to single windows."""
    from gatefold.llm import suffix_dedup

    rng = random.Random(14)
    passage, other = pseudo(rng, 30), pseudo(rng, 30)
    texts: list[str | None] = [f"{pseudo(rng, 12)} {passage} {pseudo(rng, 9)}" for _ in range(60)]
    texts += [f"{pseudo(rng, 12)} {passage[: 70 + k]} {pseudo(rng, 9)}" for k in range(20)] + [f"{pseudo(rng, 5)}{other}{pseudo(rng, 5)}" for _ in range(5)] + texts[:4] + ["a" * 300, None]
    rows = list(enumerate(texts))
    want = brute_cut(texts, 80)
    for most in (3, 20):
        monkeypatch.setattr(suffix_dedup, "CONTEXTS", most)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.cut_repeats(frame(spark, rows), 80, 16).collect()}
        assert got == dict(enumerate(want))


def test_passages_of_over_fifty_words_go_from_400_bytes_on(spark):
    """A passage of 399 bytes repeats no string of 400, however many words and documents it has."""
    from gatefold.llm.suffix_dedup import cut_repeats

    rng = random.Random(21)
    short, long = (pseudo(rng, 200)[:n] for n in (399, 400))
    assert min(len(short.split()), len(long.split())) > 50
    texts = [f"{pseudo(rng, 90)}{k}{p}{9 - k}{pseudo(rng, 90)}" for p in (short, long) for k in range(4)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in cut_repeats(frame(spark, list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(brute_cut(texts, 400)))
    assert [got[i][1:3] for i in range(8)] == [(0, 0)] * 4 + [(400, 1)] * 4


def test_kept_text_is_whole_characters(spark):
    from gatefold.llm.suffix_dedup import cut_repeats

    rows = [(1, "é" + "ab" * 30 + "ü" + "x"), (2, "\u4e2d" + "ab" * 30 + "\u4e2d")]
    got = {r.doc_id: r.text for r in cut_repeats(frame(spark, rows), 41, 8, keep="text").collect()}
    want = {i: k.decode("utf-8", "ignore") for (i, _), (_, _, _, k) in zip(rows, brute_cut([t for _, t in rows], 41), strict=True)}
    assert got == want


# ---------------------------------------------------------------- 9
def test_rendezvous_moves_rows_only_into_the_new_shard(docs):
    from gatefold.llm.sharding import shard_documents

    rows = shard_documents(docs, 4).collect()
    assert all(r.grown_shard in (r.shard, 4) for r in rows)
    by: dict[int, list[int]] = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_rendezvous_weights(spark):
    from gatefold.llm.sharding import rendezvous

    n = spark.range(20_000).select(rendezvous(F.col("id"), {0: 1.0, 1: 3.0}).alias("s")).groupBy("s").count().collect()
    assert abs({r.s: r["count"] for r in n}[1] / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        rendezvous(F.col("id"), {0: 0.0})


# ---------------------------------------------------------------- 10
def test_raking_meets_targets(spark):
    from gatefold.llm.mixing import rake

    rng = random.Random(1)
    cells = [(s, x, t, rng.randrange(50, 5000), 10) for s in "ab" for x in "uv" for t in "pqr"]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long, docs long")
    want = {"source": {"a": 0.7, "b": 0.3}, "lang": {"u": 0.25}, "topic": {"p": 0.2, "q": 0.5, "r": 0.3}}
    rows = rake(df, targets=want, sweeps=40).collect()
    w = {(r.source, r.lang, r.topic): r.tokens * r.p for r in rows}
    total = sum(w.values())
    for k, dim in enumerate(("source", "lang", "topic")):
        for v, share in want[dim].items():
            assert abs(sum(x for c, x in w.items() if c[k] == v) / total - share) < 1e-6
    assert abs(max(r.p for r in rows) - 1) < 1e-12
    assert 0 <= rows[0].residual < 1e-6 < rake(df, targets=want, sweeps=1).first().residual


def test_mixing_samples_near_its_weights(spark):
    from gatefold.llm.mixing import mix

    rows = [(i, "w " * 20, "en", "big" if i % 4 else "small") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mix(df, targets={"source": {"big": 0.5, "small": 0.5}}).filter("kept").groupBy("source").count().collect()
    n = {r.source: r["count"] for r in got}
    assert n["small"] == 1000 and abs(n["big"] - 1000) < 120


# ---------------------------------------------------------------- odd tables
def operators():
    from gatefold.llm import byte_bpe, line_dedup, matroska, mixing, near_dedup, quality, rans_ids, sharding, suffix_dedup
    from gatefold.llm.common import stored

    return {
        "near": near_dedup.near_duplicates, "media": matroska.media_round_trip, "lines": line_dedup.line_dedup, "quality": quality.judge, "filter": quality.quality_filter,
        "rans": lambda d: rans_ids.read_documents(stored(rans_ids.encode_documents(d), "t")), "bpe": byte_bpe.round_trip, "suffix": suffix_dedup.cut_repeats, "shards": sharding.shard_documents, "mix": mixing.mix,
    }


LONG = " ".join(f"word{k % 7919}x{k % 13}" for k in range(130_000))


def test_texts_longer_than_a_part(spark):
    """Texts of over 1 MB, the size of the parts that become Python objects at a time, beside short ones."""
    import tiktoken
    from tokenizers import Tokenizer

    from gatefold.llm import byte_bpe, matroska, near_dedup, quality, rans_ids
    from gatefold.llm.common import stored

    assert len(LONG) > 1 << 20
    rows = [(1, "a short text of some words"), (2, LONG), (3, LONG[:-9]), (4, "b"), (5, None)]
    df = frame(spark, rows).coalesce(1)
    text = dict(rows)
    near = {r.doc_id: r for r in near_dedup.near_duplicates(df, 3, 85).collect()}
    assert near[2].n_shingles == len(shingles(LONG, 3)) and [near[k].component_id for k in (1, 2, 3, 4)] == [1, 2, 2, 4]
    media = {r.doc_id: r for r in matroska.media_round_trip(df).collect()}
    assert all(media[i].n_bytes == len((t or "").encode()) for i, t in rows)
    base = {r.doc_id: r for r in quality.judge(df).collect()}
    assert base[2].n_words == 130_000 and base[4].n_words == 1
    lib = Tokenizer.from_file(rans_ids.default_path())
    ids = {r.doc_id: r for r in rans_ids.read_documents(stored(rans_ids.encode_documents(df, parts=2), "t")).collect()}
    assert all(ids[i].n_tokens == len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows)
    bpe = {r.doc_id: r for r in byte_bpe.round_trip(df).collect()}
    assert all(bpe[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in rows)
    assert tiktoken and text[2] == LONG


@pytest.mark.parametrize("name", ["near", "media", "lines", "quality", "filter", "rans", "bpe", "suffix", "shards", "mix"])
def test_odd_and_empty_tables(name, odd, empty):
    op = operators()[name]
    assert op(empty).count() == 0
    n = op(odd).count()
    assert n == odd.count() or name == "filter"


def test_odd_results(odd):
    from gatefold.llm.near_dedup import near_duplicates
    from gatefold.llm.suffix_dedup import cut_repeats

    near = near_duplicates(odd).collect()
    assert {r.component_id for r in near if r.doc_id in (1, 3)} == {1}
    assert all(r.kept and r.component_id is None for r in near if r.doc_id is None)
    cut = {r.doc_id: r for r in cut_repeats(odd).collect()}
    assert cut[1].n_removed == cut[1].n_bytes == 780 and cut[2].n_bytes == 0
    assert cut[5].n_removed == 1800


def test_line_dedup_keeps_all_columns(odd):
    from gatefold.llm.line_dedup import line_dedup

    out = line_dedup(odd)
    assert out.columns == odd.columns and out.filter("_id = 'x' and pos = 1").count() == odd.count()


def test_oracles_are_registered():
    import __spark_entry__ as e

    q = e.queries()
    assert [n for n in q if n.startswith("op")] and all(k in q for k in e.oracle_sql())
    assert sorted({int(n[2:].split("_")[0]) for n in q if re.match(r"op\d+_", n)}) == list(range(1, 11))
