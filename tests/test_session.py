import pytest

from shelfwise import session as SE

BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def plain(spark):
    old = {k: spark.conf.get(k, None) for k in (BYTES, PARTS)}
    for k in old:
        spark.conf.unset(k)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tasks_grow_in_number_not_in_size(plain):
    default = int(plain.conf.get("spark.sql.shuffle.partitions"))
    SE.size_tasks(plain, 1000)
    assert (plain.conf.get(BYTES), plain.conf.get(PARTS)) == (SE.TASK_BYTES, str(default))
    SE.size_tasks(plain, 100 * SE.TASK_ROWS + 1)  # a larger table in the same session
    assert plain.conf.get(PARTS) == "101"
    SE.size_tasks(plain, 1000)
    assert plain.conf.get(PARTS) == str(default)


def test_task_settings_of_the_platform_stay(plain):
    plain.conf.set(BYTES, "32MB")
    plain.conf.set(PARTS, "77")
    SE.size_tasks(plain, 100 * SE.TASK_ROWS)
    assert (plain.conf.get(BYTES), plain.conf.get(PARTS)) == ("32MB", "77")


def test_binding_sizes_the_tasks(plain, tmp_path):
    from shelfwise.sources import tpch
    for name, schema in tpch.SCHEMAS.items():
        plain.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert tpch.retail_raw(plain, str(tmp_path)).count() == 0
    assert plain.conf.get(BYTES) == SE.TASK_BYTES


def test_package_is_shipped_once_from_several_threads():
    """Tuning fits in parallel; Spark refuses a second file of the same name."""
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    from shelfwise.session import ship_package
    sent = []

    def add(path):
        time.sleep(0.2)
        sent.append(path)
    fake = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-threads", addPyFile=add))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(ship_package, [fake] * 4))
    assert len(sent) == 1
