"""The derived events reach every rule, so that a missing one shows in the comparison with SQL."""

from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SF_DIR
from kerbstone import rules
from kerbstone.operators.silver import typed


def test_every_list_limit_and_cast_is_reached(spark):
    valid = contract._valid(spark, SF_DIR)
    rows = typed(valid)
    read = {
        f"list {c}": F.count_if(~F.col(c).isin(*values)) for c, values in rules.ALLOWED.items()
    }
    for c, (low, high) in rules.LIMITS.items():
        read |= {f"below {c}": F.count_if(F.col(c) < low), f"above {c}": F.count_if(F.col(c) > high)}
    found = rows.agg(*(n.alias(name) for name, n in read.items())).first().asDict()
    texts = valid.agg(*(F.count(c).alias(c) for c in (*rules.DOUBLES, *rules.INTEGERS))).first()
    casts = rows.agg(*(F.count(c).alias(c) for c in (*rules.DOUBLES, *rules.INTEGERS))).first()
    found |= {f"cast {c}": texts[c] - casts[c] for c in casts.asDict()}
    found |= {"cast event_time": rows.where("event_time_ts is null").count()}
    found |= {"cast ingested_at": rows.where("ingested_at_ts is null").count()}
    assert {name for name, n in found.items() if not n} == set()
