import random

from parlance.functions.ranks import ceil_rank, pick_ranks


def test_pick_ranks_of_fractional_values(spark):
    rng = random.Random(4)
    values = [(g, rng.choice([rng.random(), 0.25, -rng.random() * 3, 7.0])) for g in ("a", "b", None) for _ in range(500)]
    picks = {"low": 0.0, "half": 0.5, "high": 0.95, "top": 1.0}
    found = pick_ranks(spark.createDataFrame(values + [("a", None)], "g string, v double"), ["g"], "v", picks, ceil_rank)
    got = {r["g"]: [r[name] for name in picks] for r in found.collect()}
    for g in ("a", "b", None):
        order = sorted(v for k, v in values if k == g)
        spots = [max(0, min(499, -(-int(p * 50000) // 100) - 1)) for p in picks.values()]
        assert got[g] == [order[s] for s in spots]
