import numpy as np
import pytest

from tidewatt.llm.neighbours import balanced_seeds, fit_router, nearest_neighbours, neighbour_graph, op13_learned_partitions, refined_cut, unit_rows

SCHEMA = "vec_id long, embedding array<float>, part int, width int, chunk int, kind int, ids string, score string"


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 1, 2, 3, 4, "x", "y") for i, v in rows], SCHEMA)

    return build


def usable(v):
    return v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)


def brute(rows, queries, nearest=5):
    held = {i: np.array(v, np.float64) for i, v in rows if i is not None and usable(v)}
    out = {}
    for q in queries:
        if q in held:
            near = []
            for i, v in held.items():
                if i != q and len(v) == len(held[q]):
                    near.append((-float((v * held[q]).sum() / (np.sqrt((v * v).sum()) * np.sqrt((held[q] ** 2).sum()))), i))
            out[q] = [(i, -s) for s, i in sorted(near)[:nearest]]
    return out


def answers(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = [len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()]
    return sum(hits) / max(1, sum(map(len, want.values())))


def clustered(count, width, groups, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, width))
    found = centres[draw.integers(groups, size=count)] + 0.35 * draw.normal(size=(count, width))
    return [(i, [float(x) for x in v]) for i, v in enumerate(found.astype(np.float32))]


def test_query_finds_the_nearest(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got, want = answers(op13_learned_partitions(spark, small)), brute(rows, [i for i, _ in rows if i % 50 == 0])
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        exact = {i: s for i, s in brute(rows, [q], nearest=10**6)[q]}
        assert all(abs(s - exact[i]) < 1e-12 for i, s in found)


def test_structured_table_is_pruned(vectors):
    rows = clustered(6000, 16, 60)
    router = fit_router(np.array([v for _, v in rows[:4000]]), len(rows) * 8)
    assert router.parts == 46 and router.visits <= 12
    frame = vectors(rows)
    got, want = answers(nearest_neighbours(frame, frame.where("vec_id % 50 = 0"))), brute(rows, range(0, 6000, 50))
    assert recall(got, want) >= 0.9


def test_cut_is_balanced_and_refinement_keeps_more_edges():
    unit = unit_rows(np.array([v for _, v in clustered(1200, 8, 30, 2)]))
    graph = neighbour_graph(unit, unit, 8, own=True)
    room = 132
    first = balanced_seeds(unit, 10, room, np.random.default_rng(0), rounds=1)
    inside = lambda part: (part[graph] == part[:, None]).mean()
    before = inside(first)
    second = refined_cut(first.copy(), graph, 10, room)
    assert np.bincount(first, minlength=10).max() <= room and np.bincount(second, minlength=10).max() <= room
    assert inside(second) > before


def test_a_third_of_all_rows_is_one_vector(vectors):
    rows = clustered(600, 8, 10, 3) + [(i, [1.0] * 8) for i in range(600, 900)]
    frame = vectors(rows)
    got, want = answers(nearest_neighbours(frame, frame.where("vec_id % 50 = 0"))), brute(rows, range(0, 900, 50))
    for q in range(600, 900, 50):
        assert [i for i, _ in got[q]] == [i for i in range(600, 606) if i != q][:5]
        assert len({s for _, s in got[q]}) == 1 and got[q][0][1] == pytest.approx(1.0)
    assert recall(got, want) >= 0.9


def test_unusable_rows_other_lengths_and_repeats(vectors):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0])]
    rows += [(8, [float("inf"), 1.0]), (None, [1.0, 0.0]), (50, [3.0, 0.0]), (50, [3.0, 0.0]), (100, [1.0, 0.0, 0.0]), (101, [1.0, 1.0, 0.0]), (150, [0.0, 0.0]), (200, [1e-30, 1e-30])]
    frame = vectors(rows)
    got, want = answers(nearest_neighbours(frame, frame.where("vec_id % 50 = 0"))), brute(rows, [0, 50, 100, 150, 200])
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}
    assert got[0] == [(1, 1.0), (50, 1.0), (200, pytest.approx(0.5**0.5)), (2, 0.0)]


def test_empty_and_single(vectors):
    assert answers(nearest_neighbours(vectors([]), vectors([]))) == {}
    one = vectors([(0, [1.0, 2.0])])
    assert answers(nearest_neighbours(one, one)) == {}
