"""JSON lists read by many tasks, against Python's parser."""

import json
import random

from pyspark.sql import functions as F

from tessera.sources.files import read_master_json
from tessera.sources.json_list import read_list_objects, read_master_json_list


def _object(rng, depth=0):
    text = lambda: "".join(rng.choice('ab{}[]",: \\é\n\u2028') for _ in range(rng.randrange(12)))
    return {f"k{i}{text()}": rng.choice([text(), 1.5, None, True, [text(), {}], _object(rng, depth + 1) if depth < 3 else {}]) for i in range(rng.randrange(4))}


def test_objects_equal_the_parser(spark, workdir):
    rng = random.Random(8)
    lists = [[_object(rng) for _ in range(n)] for n in (0, 1, 7, 400)]
    import os
    os.makedirs(f"{workdir}/in")
    for i, x in enumerate(lists):
        with open(f"{workdir}/in/{i}.json", "w", encoding="utf-8") as f:
            json.dump(x, f, ensure_ascii=bool(i % 2), indent=rng.choice([None, 1]))
    for size in ("64", "1000", "128m"):  # blocks of some bytes cut strings and objects anywhere
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = {}
            for r in read_list_objects(spark, f"{workdir}/in").orderBy("file", "number").collect():
                got.setdefault(int(r["file"].rsplit("/", 1)[-1][0]), []).append(json.loads(r["object"]))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == {i: x for i, x in enumerate(lists) if x}


def test_master_list_equals_the_whole_file_reader(spark, workdir):
    rows = [{"id": str(i), "name": f"N}}{{ \"{i}\\", "house": None if i % 3 == 0 else f"H{i}"} for i in range(500)]
    with open(f"{workdir}/m.json", "w") as f:
        json.dump(rows, f)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        many = read_master_json_list(spark, f"{workdir}/m.json")
        assert sorted(tuple(r) for r in many.collect()) == sorted((tuple(r) for r in read_master_json(spark, f"{workdir}/m.json").collect()))
        assert spark.read.option("lineSep", "}").text(f"{workdir}/m.json").select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
