import datetime as dt


from footfall.operators import dims
from footfall.plans.daily import empty_dims, extend_dims, load_dims, save_dims
from footfall.schemas import DIM_LOCATION, DIM_PLATFORM


def _platforms(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "platform_name string")


def test_new_keys_follow_the_largest_id(spark):
    dim = spark.createDataFrame([(7, "pc"), (3, None)], DIM_PLATFORM)
    facts = _platforms(spark, "pc", None, "web", "app", "web")
    out = dims.get_or_create_dim(facts, dim, dims.PLATFORM_KEYS)
    assert {r.platform_name: r.id for r in out.collect()} == {None: 3, "pc": 7, "app": 8, "web": 9}
    again = dims.get_or_create_dim(facts, out, dims.PLATFORM_KEYS)
    assert sorted(r.id for r in again.collect()) == [3, 7, 8, 9]


def test_numbering_is_dense_and_ordered(spark):
    names = [f"{i % 7}-{i}" for i in range(500)]
    facts = _platforms(spark, *names, None)
    empty = empty_dims(spark)["platform"]
    out = dims.get_or_create_dim(facts, empty, dims.PLATFORM_KEYS).collect()
    wanted = {n: i for i, n in enumerate([None, *sorted(names)], 1)}
    assert {r.platform_name: r.id for r in out} == wanted


def test_ids_of_a_report(spark):
    report = spark.createDataFrame(
        [
            (dt.date(2024, 1, 1), "pc", "A", None, "c", 1),
            (dt.date(2024, 12, 31), "all", "A", "", "c", 2),
        ],
        "dt date, platform string, country string, province string, city string, sessions int",
    )
    found = extend_dims(empty_dims(spark), [report])
    assert found["event"].count() == 0
    rows = sorted(tuple(r) for r in dims.resolve_report_ids(report, found).collect())
    assert rows == [
        (1, 2, 1, 1, "2024-01-01", dt.date(2024, 1, 1)),
        (2, 1, 2, 2, "2024-12-31", dt.date(2024, 12, 31)),
    ]
    dates = found["date"].orderBy("id").collect()
    assert tuple(dates[1]) == (2, 2024, 4, 12, 1, 31, "2024-12-31", "day")


def test_saved_dimensions_grow(spark, folder):
    root = folder("dims")
    assert load_dims(spark, root)["location"].count() == 0
    first = spark.createDataFrame([(1, "A", "x", "y")], DIM_LOCATION)
    save_dims(spark, {"location": first}, root)
    more = spark.createDataFrame([(2, "B", "x", "y")], DIM_LOCATION)
    save_dims(spark, {"location": load_dims(spark, root)["location"].unionByName(more)}, root)
    assert sorted(r.id for r in load_dims(spark, root)["location"].collect()) == [1, 2]
