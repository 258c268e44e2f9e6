"""The stock price fixture: ten raw lines, one table, six rolled-up lines."""

from rollmill.spec import (
    BatchSpec,
    Channel,
    Dimension,
    IndexerSpec,
    Metric,
    ParseSpec,
    Partitioning,
    RealTimeSpec,
    TableSpec,
)

RAW = [
    ("Tern", "2016-05-10", "40.25"),
    ("Tern", "2016-05-10", "41.5"),
    ("Tern", "2016-05-11", "39.0"),
    ("Tern", "2016-05-11", "42.75"),
    ("Tern", "2016-05-12", "38.5"),
    ("Alder", "2016-05-10", "7.5"),
    ("Alder", "2016-05-10", "8.25"),
    ("Alder", "2016-05-11", "6.0"),
    ("Alder", "2016-05-11", "9.5"),
    ("Alder", "2016-05-12", "2.25"),
]
RAW_LINES = ["\t".join(r) for r in RAW]
PERIODS = [1462838400000, 1462924800000, 1463011200000]
# Added up by hand: company, day, sum, average (kept as a sum), maximum, count.
GOLDEN = [
    "Alder\t2016-05-10\t15.75\t15.75\t8.25\t2",
    "Alder\t2016-05-11\t15.5\t15.5\t9.5\t2",
    "Alder\t2016-05-12\t2.25\t2.25\t2.25\t1",
    "Tern\t2016-05-10\t81.75\t81.75\t41.5\t2",
    "Tern\t2016-05-11\t81.75\t81.75\t42.75\t2",
    "Tern\t2016-05-12\t38.5\t38.5\t38.5\t1",
]


def table(name="foo", **kwargs):
    return TableSpec(
        name=name,
        dimensions=(Dimension("company"), Dimension("timestamp", type="time", format="%Y-%m-%d")),
        metrics=(
            Metric("stock_price_sum", "double_sum", field="stock_price"),
            Metric("stock_price_avg", "double_avg", field="stock_price"),
            Metric("stock_price_max", "double_max", field="stock_price"),
            Metric("count", "count"),
        ),
        **kwargs,
    )


def indexer(root, partitions=3, snapshots="whole", **batch):
    """Whole snapshots, whose folders hold all lines, unless told otherwise."""
    return IndexerSpec(
        store=f"{root}/store",
        real_time=RealTimeSpec(
            parse=ParseSpec(
                format="tsv",
                columns=("company", "timestamp", "stock_price"),
                time_column="timestamp",
                time_formats={"timestamp": "%Y-%m-%d"},
            ),
            channel=Channel("file", str(root), "rt"),
        ),
        batch=BatchSpec(
            channel=Channel("file", str(root), "b"),
            partitioning=Partitioning(("company",), partitions) if partitions else None,
            snapshots=snapshots,
            **batch,
        ),
    )


def store_lines(spark, path):
    reader = spark.read.option("recursiveFileLookup", True)
    return sorted(r[0] for r in reader.text(path).collect())


def file_source(spark, indexer):
    """A stream source hook: text files next to the store."""
    return spark.readStream.text(f"{indexer.store}/../raw")
