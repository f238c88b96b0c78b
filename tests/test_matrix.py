import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import matrix


@pytest.fixture(scope="module")
def coords(spark):
    def make(array):
        return spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(array)], "i long, j long, v double")

    return make


def dense(df):
    n, m = matrix.shape(df)
    out = np.full((n, m), np.nan)
    for r in df.collect():
        out[r.i, r.j] = r.v
    return out


SMALL = np.array([[1, 2], [3, 4], [5, 6]])


def test_sums(spark):
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(SMALL)], "id long, a array<double>")
    assert matrix.reduce_all(df, "a").first().sum == 21
    assert [r.sum for r in matrix.reduce_columns(df, "id", "a").orderBy("j").collect()] == [9, 12]
    assert [r.sum for r in matrix.reduce_rows(df, "id", "a").orderBy("i").collect()] == [3, 7, 11]


def test_reshape(coords):
    df = coords(SMALL)
    assert np.array_equal(dense(matrix.reshape(df, (3, 2), (-1, 3))), SMALL.reshape(-1, 3))
    assert np.array_equal(dense(matrix.reshape(df, (3, 2), (1, -1))), SMALL.reshape(1, -1))
    for bad in ((4, 2), (-1, 4), (-1, -1)):
        with pytest.raises(ValueError):
            matrix.reshape(df, (3, 2), bad)


@pytest.mark.parametrize("broadcast_cells", [0, 10**6])
@pytest.mark.parametrize("shapes", [((3, 1), (1, 3)), ((7, 5), (5, 9)), ((4, 11), (11, 1))])
def test_matmul(coords, shapes, broadcast_cells):
    rng = np.random.default_rng(4)
    a, b = rng.random(shapes[0]), rng.random(shapes[1])
    product = matrix.matmul(coords(a), coords(b), block=3, broadcast_cells=broadcast_cells)
    assert np.allclose(dense(product), a @ b)


def test_matmul_checks_inner_sizes(coords):
    with pytest.raises(ValueError):
        matrix.matmul(coords(np.ones((3, 1))), coords(np.ones((3, 1))))


def test_transpose_slice_stack(coords):
    df = coords(SMALL)
    assert np.array_equal(dense(matrix.transpose(df)), SMALL.T)
    assert np.array_equal(dense(matrix.slice_block(df, rows=(0, None, 2), columns=(1, 2, 1))), SMALL[::2, 1:2])
    assert dense(matrix.stack_horizontal(df, df, 2)).shape == (3, 4)
    assert np.array_equal(dense(matrix.stack_vertical(df, df, 3)), np.vstack([SMALL, SMALL]))


def test_column_vector(coords, spark):
    vector = spark.createDataFrame([(0, 10.0), (1, 20.0), (2, 30.0)], "i long, v double")
    assert np.array_equal(dense(matrix.add_column_vector(coords(SMALL), vector)), SMALL + np.array([[10], [20], [30]]))


def test_elementwise(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0])], "id long, a array<double>")
    out = matrix.combine_elements(matrix.map_elements(df, "a", {"sq": lambda v: v * v}), "a", "sq", lambda x, y: x + y, "s").first()
    assert (out.sq, out.s) == ([1.0, 4.0], [2.0, 6.0])


@pytest.mark.parametrize("cells", [0, 10**9])
def test_product_rows_do_not_depend_on_the_block(coords, cells):
    sparse = np.array([[1, 0, 0], [0, 0, 2], [0, 3, 0]])
    results = []
    for block in (1, 7, 256):
        df = matrix.matmul(coords(sparse).where("v <> 0"), coords(sparse).where("v <> 0"), block=block, broadcast_cells=cells)
        results.append(sorted(tuple(r) for r in df.collect()))
    assert results[0] == results[1] == results[2] == [(0, 0, 1.0), (1, 1, 6.0), (2, 2, 6.0)]


def test_missing_vector_entry_is_an_error(spark, coords):
    vector = spark.createDataFrame([(0, 1.0)], "i long, v double")
    with pytest.raises(Exception, match="no entry"):
        matrix.add_column_vector(coords(SMALL), vector).collect()


@pytest.mark.parametrize("fill", [0.0, 0.002, 0.05, 0.5, 1.0])
def test_blocks_by_cells_and_dense_agree(fill):
    """One block pair; products that cancel keep their row, cells without a product have none."""
    rng, block = np.random.default_rng(4), 64
    a, b = (np.where(rng.random((block, block)) < max(fill, 1 / block**2), rng.integers(-2, 3, (block, block)), 99.0) for _ in "ab")
    places = [np.flatnonzero(m != 99) for m in (a, b)]
    rng.shuffle(places[0])
    rng.shuffle(places[1])
    values = [m.ravel()[p] for m, p in zip((a, b), places)]
    there = [(m != 99).astype(float) for m in (a, b)]
    expected = np.where(a != 99, a, 0) @ np.where(b != 99, b, 0)
    cells = np.flatnonzero(there[0] @ there[1])
    for share in (0.0, 2.0):
        monkey = matrix.SPARSE_SHARE
        matrix.SPARSE_SHARE = share
        try:
            at, v = matrix.multiply_blocks(places[0], values[0], places[1], values[1], block)
        finally:
            matrix.SPARSE_SHARE = monkey
        order = np.argsort(at)
        assert at[order].tolist() == cells.tolist() and np.allclose(v[order], expected.ravel()[cells])


def test_sparse_product_needs_no_block(spark, plan_of):
    """A million rows and columns with one cell per row each: as many products as cells meet, no Python, no dense block."""
    n = 1_000_000
    a = spark.range(n).selectExpr("id AS i", "(id * 7919) % 1000000 AS j", "CAST(id % 10 AS double) AS v")
    b = spark.range(n).selectExpr("id AS i", "(id * 104729) % 1000000 AS j", "CAST(id % 7 AS double) AS v")
    product = matrix.matmul(a, b, shapes=((n, n), (n, n)))
    assert "Python" not in plan_of(product) and "InPandas" not in plan_of(product)
    i = np.arange(n)
    k = i * 7919 % n
    got = product.agg(F.count("*"), F.sum("v"), F.sum(F.col("v") * (F.col("j") % 1000))).first()
    assert got[0] == n and got[1] == ((i % 10) * (k % 7)).sum() and got[2] == ((i % 10) * (k % 7) * (k * 104729 % n % 1000)).sum()


@pytest.mark.parametrize("share", [0.0, 1.1])
@pytest.mark.parametrize("cells", [0, 10**9])
def test_sparse_and_blocked_products_agree(coords, share, cells):
    rng = np.random.default_rng(6)
    a, b = (np.where(rng.random(s) < 0.1, rng.random(s), 0) for s in ((40, 30), (30, 50)))
    product = matrix.matmul(coords(a).where("v <> 0"), coords(b).where("v <> 0"), block=8, broadcast_cells=cells, filled_share=share, shapes=((40, 30), (30, 50)))
    got = np.zeros((40, 50))
    for r in product.collect():
        got[r.i, r.j] = r.v
    assert np.allclose(got, a @ b) and product.count() == np.count_nonzero((a != 0).astype(int) @ (b != 0))
