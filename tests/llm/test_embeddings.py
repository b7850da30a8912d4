import numpy as np

from tripcraft.llm import embeddings


def brute(rows, threshold=0.9):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, dtype=np.float64)
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    near = [[j for j, y in enumerate(units) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= threshold]
            for i, x in enumerate(units)]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            todo = [j for k in todo for j in near[k] if j not in seen]
            seen.update(todo)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return out


def test_random_clusters_over_several_tiles(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(int(k), (centres[k % 12] + rng.normal(scale=0.35, size=16)).astype(np.float32).tolist()) for k in rng.permutation(300)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile=64).collect())
    assert got == sorted(brute(rows))


def test_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]),
            (7, [0.0, 1.0]), (None, [0.0, 3.0]), (8, []), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1e30, -0.0]), (12, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label string, vid int")
    got = embeddings.near_duplicates(df).collect()
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_bound_is_rigorous():
    rng = np.random.default_rng(2)
    x = embeddings.unit_rows(rng.standard_t(2, size=(400, 24)))
    codes, scale, error = embeddings.quantise(x)
    approximate = (codes.astype(float) @ codes.astype(float).T) * scale[:, None] * scale[None, :]
    bound = (1 + error)[:, None] * (1 + error)[None, :] - 1
    assert (np.abs(x @ x.T - approximate) <= bound + 1e-12).all()


def test_pairs_around_the_threshold_are_decided_by_their_doubles(spark):
    """A family whose cosines lie about 0.9, most of them within the quantisation error: open by the codes."""
    rng = np.random.default_rng(8)
    u = embeddings.unit_rows(rng.normal(size=(180, 64)))
    u[:, 0] = 0
    x = np.sqrt(0.1) * embeddings.unit_rows(u)
    x[:, 0] = np.sqrt(0.9)
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(500 + k, (2 * x[k]).tolist()) for k in range(3)] + [(900, x[7].tolist())]
    codes, scale, error = embeddings.quantise(embeddings.unit_rows(x))
    part = {"codes": codes, "scale": scale, "error": error}
    seen = list(embeddings.tile_links(part, part, True, 0.9))
    assert sum((~sure).sum() for _, _, sure in seen) > 8000  # of 16110 pairs
    for tile in (50, 4096):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(
            spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=tile).collect())
        assert got == sorted(brute(rows)), tile


def test_only_codes_go_to_the_groups(spark):
    """A copy of a vector in the shuffle holds a byte per component and five numbers."""
    import io
    from contextlib import redirect_stdout
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(k, rng.normal(size=8).tolist()) for k in range(20)], "vec_id long, embedding array<double>")
    kept, plans = embeddings.stored, []

    def spy(frame, name):
        if name == "vector-pairs":
            with redirect_stdout(io.StringIO()) as text:
                frame.explain("formatted")
            plans.append(text.getvalue())
        return kept(frame, name)

    embeddings.stored = spy
    try:
        embeddings.near_duplicates(df).count()
    finally:
        embeddings.stored = kept
    assert len(plans) == 1 and "codes" in plans[0] and "raw" not in plans[0]
