"""Golden movement numbers (FIXTURES.md section 3), agreed by both engines beforehand.

Simplifications of the golden table: current amount for every set, ghosts
listed on their own, clean-up split kept.
"""

import pytest
from pyspark.sql import functions as F

from pipewright.functions.money import money, usd
from pipewright.plans.movement import V3, Movement
from pipewright.registry import PARAMS

from .conftest import SF001, SF01

GOLDEN = {
    SF001: {"Starting Pipe": (33, 30, 6662632.4230, 11, 5), "Pulled In": (6, 6, 249133.1877, 2, 1),
            "Clean Up Pulled In": (3, 3, 896081.9445, 2, 0), "New Pipe": (8, 7, 896239.7813, 1, 0),
            "Pushed": (2, 1, 960.8729, 1, 0), "Ghost": (9, 9, 740840.7414, 3, 0),
            "Total": (50, 48, 8006674.4216, 17, 4)},
    SF01: {"Starting Pipe": (351, 327, 50708851.8069, 78, 37), "Pulled In": (30, 28, 6335541.0945, 6, 1),
           "Clean Up Pulled In": (24, 23, 3353630.6646, 6, 4), "New Pipe": (70, 65, 12328682.3972, 19, 6),
           "Pushed": (41, 39, 4651722.6078, 13, 6), "Ghost": (84, 76, 12806089.9926, 25, 9),
           "Total": (427, 396, 67887263.1620, 105, 40)},
}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_golden_sets(spark, sf):
    m = Movement(spark, sf, PARAMS, V3)
    cur = m.current.select(F.col("Id").alias("cid"), F.col("QB_USD").alias("cur_qb"))
    sets = {"Starting Pipe": m.starting, "Pulled In": m.pulled_in.where(F.col("Movement_Type") == "Pulled In"),
            "Clean Up Pulled In": m.pulled_in.where(F.col("Movement_Type") == "Clean Up Pulled In"),
            "New Pipe": m.new_pipe, "Pushed": m.pushed, "Ghost": m.ghost, "Total": m.total}
    for name, df in sets.items():
        r = (df.join(cur, df.Id == cur.cid)
               .agg(F.countDistinct("Id"), F.count("cur_qb"), usd(F.sum(money(F.col("cur_qb")))),
                    F.count(F.when(F.col("StageName") == "Closed Won", 1)),
                    F.count(F.when(F.col("StageName") == "Closed Lost", 1))).collect()[0])
        deals, with_amt, amount, won, lost = GOLDEN[sf][name]
        assert (r[0], r[1], r[3], r[4]) == (deals, with_amt, won, lost), name
        assert r[2] == pytest.approx(amount, abs=1e-4), name
