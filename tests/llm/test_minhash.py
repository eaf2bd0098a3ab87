"""Op 7 against comparing all pairs of sets."""

import random
import re
from collections import Counter, defaultdict

import pytest

from panelspark.llm import op7_minhash as op
from panelspark.llm.common import Scratch
from llm_fixtures import docs_of  # noqa: F401


def brute(rows, percent=85, k=5):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                up[find(a)] = find(b)
    group = defaultdict(list)
    for x in range(len(rows)):
        if rows[x][0] is not None:
            group[find(x)].append(rows[x][0])
    return sorted((rows[x][0], len(sets[x]), min(group[find(x)]) if sets[x] else rows[x][0]) for x in range(len(rows)))


def mine(docs_of, rows, **options):
    got = op.classify(docs_of(rows), **options).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(10):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 120))]
        for _ in range(rnd.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append((len(out) * 7 % 1_000_003, " ".join(copy)))
    return out + [(900_001, None), (900_002, ""), (900_003, " \t "), (900_004, "Hi  THERE"), (900_005, "hi there"), (900_006, "")]


@pytest.mark.parametrize("options", [{}, {"leaf": 4, "levels": 1}, {"leaf": 6, "levels": 2}, {"percent": 60}])
def test_components_equal_brute_force(docs_of, rows, options):
    """Small leaves force branching, the comparison in pieces and the pairs of pieces."""
    assert mine(docs_of, rows, **options) == brute(rows, options.get("percent", 85))


def test_jobs_do_not_grow_with_levels_or_overlapping_parts(docs_of, rows):
    """Large nodes down to the last level: each write is a job, and many partitions make each job slow."""
    docs = docs_of(rows)
    scratch = Scratch(docs.sparkSession)
    got = op.classify(docs, leaf=4, levels=6, scratch=scratch).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    made = Counter(re.search(r"/([a-z]+)-[0-9a-f]{12}$", p)[1] for p in scratch.paths)
    assert made["rest"] == 1 and made["nodes"] == 2 and made["leaves"] == 1
    assert sum(n for name, n in made.items() if name != "edges") <= 30


def test_rows_of_large_nodes_are_not_multiplied_by_levels(docs_of, rows):
    """The sets of large nodes are counted and dealt to deeper nodes by distinct paths, without a row for each set and level."""
    plans = []

    class Seen(Scratch):
        def write(self, df, name):
            plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
            return super().write(df, name)

    docs = docs_of(rows)
    got = op.classify(docs, leaf=4, levels=3, scratch=Seen(docs.sparkSession)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert {"rows", "parts"} <= {name for name, _ in plans}
    assert [name for name, plan in plans if name in ("nodes", "paths", "parts") and "Generate" in plan] == ["parts"]  # the numbers of pieces


def test_components_of_chains_and_stars(docs_of):
    """Chains through decreasing and shuffled nodes, a star, doubled and turned edges."""
    spark = docs_of([]).sparkSession
    path = list(range(60))
    random.Random(5).shuffle(path)
    edges = [(i, i + 1) for i in range(100, 140)] + [(1000 + a, 1000 + b) for a, b in zip(path, path[1:])] + [(2000, i) for i in range(2001, 2050)] + [(5, 3), (3, 5), (5, 3), (7, 7)]
    got = op.connected(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark)).collect()
    want = {i: 100 for i in range(101, 141)} | {1000 + i: 1000 for i in range(1, 60)} | {i: 2000 for i in range(2001, 2050)} | {5: 3}
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert op.connected(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark)).count() == 0


def test_a_chain_is_one_component(docs_of):
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100])) for i in range(20)]
    assert mine(docs_of, rows, trees=48) == brute(rows)


def test_dedup_keeps_one_row_of_each_component(docs_of):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(3, text), (3, text), (1, text + " tail"), (None, text), (7, None), (8, None), (None, "alone at last")]
    out = op.dedup(docs_of(rows))
    assert "uid" in out.columns and out.columns == docs_of(rows).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "alone at last"), (1, text + " tail"), (7, ""), (8, "")]
    assert op.dedup(docs_of([])).count() == 0 and op.classify(docs_of([])).count() == 0


def test_long_text_and_block_of_sets(docs_of):
    rnd = random.Random(9)
    long = [f"t{rnd.randint(0, 10**6)}" for _ in range(40_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:39_000])), (3, " ".join(long[:20_000]))]
    assert [(r.doc_id, r.component_id) for r in op.classify(docs_of(rows)).orderBy("doc_id").collect()] == [(1, 1), (2, 1), (3, 3)]


def test_query_on_a_table(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    got = QUERIES["op7_chosen_path_minhash"](spark, d).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


@pytest.mark.parametrize("n", [10, 11, 12])
def test_words_that_collide_as_polynomials(docs_of, n):
    """Thue-Morse words of 1,024 letters and more and their swaps are different words."""
    a = "a"
    for _ in range(n):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, b), (3, f"{a} x y z {b}"), (4, f"{b} x y z {a}"), (5, f"{a} x y z {b}")]
    assert mine(docs_of, rows) == brute(rows)
