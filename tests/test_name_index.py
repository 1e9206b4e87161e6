"""Name search by pattern: against LIKE itself, and what it reads."""

import random

from pyspark.sql import functions as F

from tessera.plans.name_index import build_name_index, required_trigrams, search_names


def test_required_trigrams():
    assert required_trigrams("abc") == ["\x02ab", "abc", "bc\x03"]
    assert required_trigrams("%bcd_%") == ["bcd"] and required_trigrams("%a%") == [] and required_trigrams("%") == []
    assert required_trigrams(r"%a\%b%") == ["a%b"] and required_trigrams("") == []


def test_search_equals_like(spark, workdir):
    rng = random.Random(6)
    names = ["".join(rng.choice("abé%_ \\") for _ in range(rng.randrange(0, 9))) for _ in range(300)] + [None, "", "a", "ab", "Łódź", "line\nbreak"]
    people = spark.createDataFrame(list(enumerate(names)), "customer_id long, last_name string")
    build_name_index(people, workdir)
    patterns = ["%ab%", "a%", "%b", "ab_%", "%a_b%a%", "", "%", "a", "Łódź", "%ne\nb%", r"%\%a%", r"a\_%", "%zzz%", "_b_", "%aba%bab%", "abé%"]
    patterns += [n.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") for n in names[:20]]
    for p in patterns:
        want = sorted(tuple(r) for r in people.where(F.col("last_name").like(p)).collect())
        assert sorted(tuple(r) for r in search_names(spark, workdir, people, p).collect()) == want, p


def test_one_bucket_is_read(spark, workdir):
    people = spark.createDataFrame([(i, f"Customer#{i:09d}") for i in range(2000)], "customer_id long, last_name string")
    build_name_index(people, workdir)
    found = search_names(spark, workdir, people, "Customer%0123%")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PartitionFilters: ")[1]
    assert "bucket#" in scan.split("PushedFilters")[0] and "EqualTo(gram," in scan and plan.count("FileScan") == 1
    assert found.count() == sum("0123" in f"{i:09d}" for i in range(2000))
