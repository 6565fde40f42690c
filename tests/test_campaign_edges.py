"""Campaign edges: against all pairs judged by hand, and by what their plans hold."""

from __future__ import annotations

import datetime
import random
import re

from cairnflow.operators import campaigns

BASE = datetime.date(2024, 1, 1)
SCHEMA = "id long, day date, " + ", ".join(f"{c} array<string>" for c in campaigns.SETS)


def judged(x, y, supply, windows):
    """(confidence, reasons, gap) of two profiles, or None."""
    both = {c: set(x[c]) & set(y[c]) for c in campaigns.SETS}
    gap = None if x["day"] is None or y["day"] is None else abs((x["day"] - y["day"]).days)
    near = lambda days: gap is None or gap <= days
    date = 0 if gap is None else next((plus for days, plus in ((14, 25), (45, 20), (120, 15), (365, 8)) if gap <= days), 0)
    window = max((windows[p] for p in both["platforms"] if p in windows), default=120)
    longest = max(120, *windows.values()) if windows else 120
    met = both["hashes"] or both["names"] or both["cves"] or (both["platforms"] and near(longest)) or (both["vendors"] and near(180)) or (both["actors"] and near(120))
    chain = bool(both["categories"] & set(supply)) and bool(both["platforms"])
    rules = (
        ("same_selected_article_content", both["hashes"], 90), ("shared_campaign_name", both["names"], 85), ("shared_cve", both["cves"], 55 + date), ("shared_vendor_or_platform", both["platforms"] and near(window), 45 + date),
        ("shared_vendor_name", not both["platforms"] and both["vendors"] and near(180), 45 + date), ("shared_actor_time_window", both["actors"] and date >= 15, 35 + date), ("shared_ransomware_family_time_window", both["families"] and date >= 15, 25 + date),
        ("shared_supply_chain_category", chain, 12), ("shared_attack_category", both["categories"] and not chain and (both["actors"] or both["cves"]), 8),
    )
    score = sum(plus for _, holds, plus in rules if holds)
    return (min(score, 100) / 100, "|".join(name for name, holds, _ in rules if holds), gap, tuple(tuple(sorted(both[c])) for c in campaigns.CARRY)) if met and score >= 55 else None


def test_edges_equal_all_pairs(spark):
    draw = random.Random(17)
    some = lambda c, n: draw.sample([f"{c}{k}" for k in range(n)], draw.choice((0, 0, 1, 2)))
    sizes = {"hashes": 25, "names": 25, "cves": 12, "platforms": 5, "vendors": 5, "actors": 5, "families": 3, "categories": 3}
    rows = [{"id": k, "day": None if draw.random() < 0.15 else BASE + datetime.timedelta(days=draw.randint(0, 500)), **{c: some(c, n) for c, n in sizes.items()}} for k in range(120)]
    for columns, supply, windows in ((campaigns.SETS, ("categories1",), {"platforms1": 400, "platforms2": 60}), (campaigns.SETS, (), None), (("cves", "platforms", "families", "categories"), (), None), (("platforms", "actors", "categories"), ("categories0",), None), (("vendors", "platforms"), (), None)):
        own = [r | {c: [] for c in campaigns.SETS if c not in columns} for r in rows]
        want = {(x["id"], y["id"]): e for x in own for y in own if x["id"] < y["id"] and (e := judged(x, y, supply, windows or {}))}
        found = spark.createDataFrame([tuple(r[c] for c in ("id", "day", *campaigns.SETS)) for r in own], SCHEMA).select("id", "day", *columns)
        given = windows and {p: (d, "same_campaign") for p, d in windows.items()}
        got = [((r.a, r.b), (r.confidence, r.reasons, r.gap_days, tuple(tuple(r[c]) for c in campaigns.CARRY))) for r in campaigns.campaign_edges(found, "id", supply, given, shared=True).collect()]
        assert dict(got) == want and len(got) == len(want) > 20
        plain = [((r.a, r.b), (r.confidence, r.reasons, r.gap_days)) for r in campaigns.campaign_edges(found, "id", supply, given).collect()]
        assert dict(plain) == {k: e[:3] for k, e in want.items()} and len(plain) == len(want)


def test_pairs_look_no_profiles_up(spark):
    """What an edge is judged by comes along with the nodes that meet: no join by the ends of pairs."""
    found = spark.createDataFrame([(k, BASE, [], [], ["c"], ["p"], [], [], ["f"], []) for k in range(4)], SCHEMA)
    for shared in (False, True):
        plan = campaigns.campaign_edges(found, "id", shared=shared)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan and not re.search(r"\b(a|b)#\d+L? = \w*node#|node#\d+L? = (a|b)#", plan)


def test_candidate_edges_move_no_profiles_by_pairs(spark):
    from cairnflow.plans import load

    plan = load().PLANS["candidate_edges"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not re.search(r"\b(a|b)#\d+L? = \w*node#|node#\d+L? = (a|b)#", plan)
