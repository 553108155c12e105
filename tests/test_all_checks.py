"""Every one of the 53 checks with a passing and a failing fixture, both
derived from the real model outputs at sf0.001."""
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.quality import (relationships, row_checks, unique,
                                        unique_combination)
from ridelake.plans.checks import model_checks
from ridelake.plans.tables import Tables

SF = "/root/testdata/sf0.001"

def expression_breakers():
    """Per expression check: a corruption that must make it fail."""
    return {
        "duration_consistency": ("trip_duration_minutes", F.lit(999.0)),
        "time_of_day_consistency": ("time_of_day", F.when(F.col("started_hour") <= 5, "Night")
                                    .otherwise("Late Night")),
    }


def _bad_value(dtype):
    if isinstance(dtype, T.StringType):
        return F.lit("__not_allowed__")
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.lit(99).cast(dtype)
    return None  # booleans cannot hold a value outside {true, false}


def _one_failure(df):
    return df.first()["failures"]


def test_every_check_passes_and_fails(spark):
    t = Tables(spark, SF)
    specs = model_checks()
    dim = t.dim_station.cache()
    seen, problems = 0, []
    for name, spec in specs.items():
        base = t.model(name).cache()
        one = base.limit(1)
        for chk in spec.rows:
            seen += 1
            pred = F.expr(chk.failing) if isinstance(chk.failing, str) else chk.failing
            good = base.filter(~F.coalesce(pred, F.lit(False)))
            if _one_failure(row_checks(good, name, [chk])) != 0:
                problems.append(("pass", name, chk.check, chk.target))
            if chk.check == "not_null":
                bad = one.withColumn(chk.target, F.lit(None).cast(base.schema[chk.target].dataType))
            elif chk.check == "accepted_values":
                v = _bad_value(base.schema[chk.target].dataType)
                if v is None:
                    continue
                bad = one.withColumn(chk.target, v)
            else:
                col, value = expression_breakers()[chk.target]
                bad = one.withColumn(col, value)
            if _one_failure(row_checks(good.unionByName(bad), name, [chk])) == 0:
                problems.append(("fail", name, chk.check, chk.target))
        for col in spec.unique:
            seen += 1
            good = base.filter(F.col(col).isNotNull()).dropDuplicates([col])
            if _one_failure(unique(good, name, col)) != 0:
                problems.append(("pass", name, "unique", col))
            if _one_failure(unique(good.unionByName(good.limit(1)), name, col)) == 0:
                problems.append(("fail", name, "unique", col))
        for keys, where in spec.combos:
            seen += 1
            src = base if where is None else base.filter(where)
            good = src.dropDuplicates(list(keys))
            if _one_failure(unique_combination(good, name, list(keys))) != 0:
                problems.append(("pass", name, "combo", keys))
            if _one_failure(unique_combination(good.unionByName(good.limit(1)), name, list(keys))) == 0:
                problems.append(("fail", name, "combo", keys))
        for col, _parent, field in spec.relations:
            seen += 1
            good = base.join(dim.select(F.col(field).alias(col)).distinct(), col, "left_semi")
            if _one_failure(relationships(good, name, col, dim, field)) != 0:
                problems.append(("pass", name, "relationships", col))
            bad = good.limit(1).withColumn(col, F.lit("__orphan__"))
            if _one_failure(relationships(good.unionByName(bad), name, col, dim, field)) == 0:
                problems.append(("fail", name, "relationships", col))
    assert seen == 53
    assert problems == []
