"""Whitening, conversation repair and URL filters against plain Python, numpy or SQL; plain, odd and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import oracle
from fareloom.llm import conversation_repair as cr
from fareloom.llm import url_filter as uf
from fareloom.llm import whitening as wh

# ---------------------------------------------------------------- whitening


def whole(vectors):
    return np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)


def plain_whitening(x, keep=4):
    """numpy on the distinct rows: n, sums, exact deviations, values and whitened rows."""
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = [int(sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))) for row in x]
    return n, deviation, (x - sums / n) @ vectors[:, :keep] / np.sqrt(values[:keep]), values[:keep] / values.sum()


def held_against_numpy(rows, x, ids, keep):
    n, deviation, whitened, explained = plain_whitening(x, keep)
    got = defaultdict(list)
    for r in rows:
        got[r.vec_id].append(r)
    assert sorted(got) == sorted(ids)
    signs = None
    for place, vec_id in enumerate(ids):
        found = sorted(got[vec_id], key=lambda r: r.component)
        assert [r.component for r in found] == list(range(1, keep + 1))
        assert {(r.n, r.deviation) for r in found} == {(n, deviation[place])}
        values = np.array([r.whitened for r in found])
        signs = np.sign(values * whitened[place]) if signs is None else signs
        assert np.allclose(values, whitened[place] * signs, rtol=1e-8, atol=1e-9)
        assert np.allclose([r.explained for r in found], explained, rtol=1e-10)
        assert all(r.identity_error < 1e-9 for r in found)


def test_whitening_like_numpy(spark, sf_dir):
    rows = wh.op11_embedding_whitening(spark, sf_dir).collect()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    held_against_numpy(rows, whole([r.embedding for r in given]), [r.vec_id for r in given], 4)


def write_embeddings(spark, folder, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, x string, n string, whitened string, d string")
    frame.write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_whitening_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = [[float(v) for v in row] for row in rng.standard_normal((60, 3)).astype(np.float32)]
    rows = [(i, v, "a", "b", "c", "d") for i, v in enumerate(vectors)]
    rows += [(100, None, *"abcd"), (101, [1.0, None, 2.0], *"abcd"), (102, [1.0, math.nan, 2.0], *"abcd")]
    rows += [(103, [math.inf, 1.0, 2.0], *"abcd"), (104, [], *"abcd"), (105, [1.0, 2.0], *"abcd"), (106, vectors[0], *"abcd")]
    folder = write_embeddings(spark, tmp_path, rows)
    found = wh.op11_embedding_whitening(spark, folder).collect()
    # A vector that comes twice weighs once in the fit; both rows are whitened.
    held_against_numpy(found, whole([*vectors, vectors[0]]), [*range(60), 106], 3)


@pytest.mark.parametrize("vectors, usable", [
    ([], []),
    ([[1.0, 2.0]], [False, False]),
    ([[1.0, 2.0]] * 5, [False, False]),
    ([[float(i), 2.0 * i] for i in range(9)], [True, False]),
    ([[3e30, -3e30], [1.0, 2.0], [-3e30, 0.5]], [True, True]),
])
def test_whitening_without_variance(spark, tmp_path, vectors, usable):
    folder = write_embeddings(spark, tmp_path, [(i, v, *"abcd") for i, v in enumerate(vectors)])
    rows = wh.op11_embedding_whitening(spark, folder).collect()
    assert len(rows) == len(vectors) * len(usable)
    for r in rows:
        assert (r.whitened is not None) == usable[r.component - 1]


def test_whitening_null_ids(spark, tmp_path):
    folder = write_embeddings(spark, tmp_path, [(None, [1.0, 2.0], *"abcd"), (None, [2.0, 1.0], *"abcd"), (7, [4.0, 4.5], *"abcd")])
    rows = wh.op11_embedding_whitening(spark, folder).collect()
    assert Counter(r.vec_id for r in rows) == {None: 4, 7: 2}


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for most in (300, 1 << 19, 1 << 30, (1 << 62) - 1):
        z = rng.integers(-most, most, size=(9000, 3), endpoint=True)
        wide = z.astype(object)
        assert (wh.exact_products(z) == wide.T @ wide).all()
        for n, rest in ((9000, [5, -4500, 0]), (1 << 40, [1 << 39, -(1 << 38), 77])):
            want = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in z[:20]]
            assert wh.deviations(z[:20], rest, n) == want


@pytest.mark.parametrize("values", [
    np.arange(24, 0, -1.0),
    np.array([5.0] * 6 + [5 + 1e-13] * 2 + [3.0, 3 + 1e-10, 1.0] + [0.0] * 5),
    np.array([1e9, 1.0, 1.0 + 1e-12, 1e-6]),
    np.ones(8),
])
def test_refined_vectors(values):
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.standard_normal((len(values),) * 2))
    a = ((q * values) @ q.T).astype(np.longdouble)
    a = (a + a.T) / 2
    found, vectors = wh.eigenpairs(a)
    size = np.abs(values).max()
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-15
    # Residuals below what float64 could show: the work is done in long double.
    assert np.abs(a @ vectors - vectors * found).max() < 2e-17 * size * len(values)


def test_refinement_starts_from_single_precision():
    """From float32 vectors two or three steps reach long double, as convergence is quadratic."""
    rng = np.random.default_rng(11)
    m = rng.standard_normal((200, 16))
    a = (m.T @ m / 200).astype(np.longdouble)
    v = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    errors = []
    for _ in range(4):
        v, _, change, _ = wh.refine_step(a, v)
        errors.append(float(change))
    assert errors[0] < 1e-3 and errors[1] < 1e-8 and errors[3] < 1e-16


# ---------------------------------------------------------------- conversation repair

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def key_of(row):
    conv, turn, role, text = row
    c = " " if conv is None else str(conv)
    sha = hashlib.sha256(f"{len(c)}:{c}{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, role.encode(), sha)


ALLOWED = {0: "su", 1: "u", 2: "a", 3: "u"}
AFTER = {"s": 1, "u": 2, "a": 3}


def plain_best(rows):
    """rows (role, forced, cut) -> cost, audit and lines, by (cost, letters) of every suffix and state."""
    memo = {}

    def best(i, q):
        if (i, q) in memo:
            return memo[i, q]
        options = []
        state, lead, lines = q, "", ()
        for inserts in range(3):
            base = 3 * inserts
            if i == len(rows):
                if state in (0, 3):
                    options.append((base, lead, lines))
            else:
                role, forced, cut = rows[i]
                cost, word, rest = best(i + 1, state)
                options.append((base + 4 + cost, lead + "D" + word, lines + rest))
                if not forced:
                    if role[:1] and role[:1] in ALLOWED[state]:
                        cost, word, rest = best(i + 1, AFTER[role[:1]])
                        options.append((base + 3 * cut + cost, lead + "K" + word, lines + ((role, i),) + rest))
                    for new in ("user", "assistant"):
                        if new[0] in ALLOWED[state]:
                            cost, word, rest = best(i + 1, AFTER[new[0]])
                            options.append((base + 3 + 3 * cut + cost, lead + "R" + word, lines + ((new, i),) + rest))
            due = "assistant" if state == 2 else "user"
            lead, lines, state = lead + "I", lines + ((due, None),), AFTER[due[0]]
        memo[i, q] = min(options, key=lambda o: o[:2])
        return memo[i, q]

    for i in range(len(rows), -1, -1):
        for q in range(4):
            best(i, q)
    return best(0, 0)


def plain_repair(given):
    """conv -> the contract's columns."""
    groups = {row[0]: [] for row in given}
    for row in plain_damage(given):
        groups[row[0]].append(row)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=key_of)
        seen, judged = set(), []
        counts = Counter()
        for _, _, role, text in rows:
            body = text.rstrip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "none"
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, lines = plain_best(judged)
        told = "\n".join(f"{role}:{'' if i is None else rows[i][3]}" for role, i in lines)
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(told.encode()).hexdigest())
    return out


def write_talks(spark, folder, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, key string, c string")
    frame.write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def repaired(spark, folder):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = cr.op12_conversation_repair(spark, folder).collect()
    found = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def random_talks(seed, talks, longest, roles=("user", "assistant", "system", "assistant", "user", "tool", "", None)):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why?", "so. ", "end.\n", "é.", "tab\x0bin", "…"]
    rows = []
    for conv in range(talks):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randint(0, 9)} of {conv}{rng.choice(['.', '', '?'])}"
            place = rng.choice([turn, turn, turn, turn, turn + 3, None])
            rows.append((conv if conv else None, place, rng.choice(roles), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_like_plain(spark, tmp_path, seed):
    rows = random_talks(seed, 250, 9)
    assert repaired(spark, write_talks(spark, tmp_path, rows)) == plain_repair(rows)


def test_repair_on_the_table(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert repaired(spark, sf_dir) == plain_repair(given)


def test_repair_of_nothing(spark, tmp_path):
    assert repaired(spark, write_talks(spark, tmp_path, [])) == {}
    nothing = hashlib.sha256(b"").hexdigest()
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (tmp_path / "one").mkdir()
    found = repaired(spark, write_talks(spark, tmp_path / "one", [(dropped, 0, "user", "Hi.")]))
    assert found == {dropped: (0, 0, 0, 0, 0, 0, "", nothing)}


def lined(result):
    out = defaultdict(list)
    for r in result.lines.collect():
        out[r.c].append((r.place, r.role, r.text))
    return {c: sorted(rows) for c, rows in out.items()}, {r.c: r.asDict() for r in result.counts.collect()}


@pytest.mark.parametrize("kind", ["mixed", "one role", "all equal", "alternating"])
@pytest.mark.parametrize("fixups", [0, 6])
def test_long_conversations_in_chunks(spark, kind, fixups):
    """A conversation cut into many chunks gives what one chunk gives, by fix-up passes and by matrices."""
    rng = random.Random(7)
    rows = []
    for turn in range(1500):
        role = {"mixed": rng.choice(["user", "assistant", "system", "tool"]), "alternating": ("user", "assistant")[turn % 2]}.get(kind, "user")
        text = "Same." if kind == "all equal" else f"Turn {turn}{rng.choice(['.', '', '!']) if kind == 'mixed' else '.'}"
        rows += [("long", turn, role, text), (f"short{turn % 90}", turn, role, text)]
    talks = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    assert lined(cr.repair(talks, chunk=16, fixups=fixups)) == lined(cr.repair(talks, chunk=100_000))
    judged, seen = [], set()
    for _, _, role, text in [r for r in rows if r[0] == "long"]:
        judged.append((role, text in seen and kind == "all equal", text[-1] not in ".!?"))
        seen.add(text)
    lines, counts = lined(cr.repair(talks, chunk=16, fixups=fixups))
    cost, audit, _ = plain_best_long(judged)
    assert (counts["long"]["cost"], counts["long"]["audit"]) == (cost, audit)


def plain_best_long(rows):
    import sys

    sys.setrecursionlimit(100_000)
    return plain_best(rows)


def test_vectors_converge_or_not():
    costs = cr.Costs()
    mixed = "uaUsaAuoauaUAosua" * 20
    ends = [cr.TERMINAL, (0, 0, 0, 0), (3, 3, 0, 3), (0, 3, 3, 0)]
    assert len({costs.start(mixed, cr.level(e)[0]) for e in ends}) == 1
    assert len({costs.start("u" * 101, cr.level(e)[0]) for e in ends}) > 1
    for symbols in (mixed, "u" * 101, "-", ""):
        for old, new in itertools.product(ends, ends):
            assert costs.fix_up(symbols, old, costs.start(symbols, old), new) == costs.start(symbols, new)
            matrix = costs.matrix(symbols)
            by_matrix = tuple(min(matrix[q][p] + new[p] for p in range(4)) for q in range(4))
            assert cr.level(by_matrix)[0] == costs.start(symbols, cr.level(new)[0])


# ---------------------------------------------------------------- URL filters


def write_pages(spark, folder, urls):
    rows = [(i, u, "<p>", "x", "y") for i, u in enumerate(urls)]
    spark.createDataFrame(rows, "page_id long, url string, html string, rule string, gram string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


def connect(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    return con


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "https://WWW.Example.COM/en/a?b#c", "http://EXAMPLE.com/en/", "http://example.com/en",
    "http://notexample.com/en/x", "http://a.b.net/es/1", "http://net/fr/1", "http://net", "http://x.com", "http://x.com?q=/en/",
    "http://x.com#://y.net/es/", "ftp://É.com/ü/", "http://com/", "http://a.net/en/\n\x00z", "http://h.org/" + "ab/c" * 5000,
    "http://\U0001f600.org/en/", "http://x.org/\u0002\u0003", "http://x.com/a", "http://x.com/a", "http://com:80/", "http://a.com./",
]


@pytest.mark.parametrize("urls", [ODD_URLS, [], ["http://a.org/"], ["http://a.com/x", "http://b.com/y", "http://c.org/y"], [None] * 3])
def test_urls_on_odd_rows(spark, tmp_path, urls):
    folder = write_pages(spark, tmp_path, urls)
    assert oracle.difference(uf.op13_url_filter(spark, folder), connect(folder), uf.oracle_sql()) is None


def test_rules(spark):
    want = {
        "https://WWW.Example.COM/en/a?b#c": ("www.example.com", "/en/a", "www.example.com/en/"),
        "http://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/"),
        "http://blog.example.com/en/": ("blog.example.com", "/en/", "example.com/en/"),
        "http://example.com/en": ("example.com", "/en", "com/"),
        "http://notexample.com/en/x": ("notexample.com", "/en/x", "com/"),
        "http://net/es/1?x": ("net", "/es/1", "net/es/"),
        "http://x.com?q=/en/": ("x.com", "", None),
        "http://h/p://b.com/": ("h", "/p://b.com/", None),
        "no scheme": ("", "", None),
    }
    urls = spark.createDataFrame([(u,) for u in want], "url string")
    found = {r.url: (r.host, r.path, r.rule) for r in uf.filter_urls(urls).collect()}
    assert found == want


def test_grams_cover_every_character(spark):
    texts = ["", "ab", "x" * 255, "y" * 256, "".join(chr(97 + i % 26) for i in range(1000)), "\U0001f600é" * 300]
    got = Counter((r.u, r.gram) for r in uf.grams(spark.createDataFrame(list(enumerate(texts)), "u long, url string"), 5).collect())
    want = Counter()
    for u, text in enumerate(texts):
        framed = uf.BEGIN + text + uf.END
        want.update((u, framed[max(0, i - 5) : i + 1]) for i in range(1, len(framed)))
    assert got == want


def test_models_tell_styles_apart(spark):
    """Hosts of one style are allowed, of another blocked; undecided hosts follow their style."""
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(12))
    good = [f"http://{word('abcde')}.com/{word('abcde')}" for _ in range(150)]
    bad = [f"http://{word('vwxyz')}.net/es/{word('vwxyz')}" for _ in range(150)]
    open_good = [f"http://{word('abcde')}.org/{word('abcde')}" for _ in range(50)]
    open_bad = [f"http://{word('vwxyz')}.org/{word('vwxyz')}" for _ in range(50)]
    urls = spark.createDataFrame([(u,) for u in good + bad + open_good + open_bad], "url string")
    found = {r.url: r.verdict for r in uf.filter_urls(urls).collect()}
    assert {found[u] for u in open_good} == {"allow"} and {found[u] for u in open_bad} == {"block"}


def test_model_tables_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Bytes of files say little of rows: only hot grams and hot URLs are broadcast, however small the files are."""
    plans, stored = {}, uf.stored

    def final_plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]

    def recorded(df, name):
        plans[name] = final_plan(df)
        return stored(df, name)

    monkeypatch.setattr(uf, "stored", recorded)
    rng = random.Random(4)
    urls = [f"http://h{i % 7}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['es', 'de'])}/{rng.random()}" for i in range(400)]
    plans["result"] = final_plan(uf.op13_url_filter(spark, write_pages(spark, tmp_path, urls + urls[:1] * 20)))
    joins = {name: (plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")) for name, plan in plans.items()}
    levels = {f"url-level-{n}": (0, 1 if n > 1 else 0) for n in range(1, uf.ORDER + 2)}
    none = dict.fromkeys(["urls", "url-grams", "url-counts", "url-ratios"], (0, 0))
    assert joins == levels | none | {"url-scores": (2, 1), "url-verdicts": (0, 1), "result": (2, 1)}
