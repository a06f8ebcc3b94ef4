"""The classifier's rates and posteriors, computed again in plain Python from its evidence, and what it does to toxic documents."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from __spark_entry__ import queries
from marigold.llm import quality_model

SF = "/root/testdata/sf0.01"


def labelled(spark):
    """Id to (quality, toxic); several labels of one id count as bad if any is."""
    found = {}
    for d, q, t in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect():
        old = found.get(d, (q, t))
        found[d] = min(q, old[0]), max(t, old[1])
    return found


def shrunk(groups, parents):
    """Rates of groups (n, good) drawn towards their parents, as strongly as they differ no more than by chance."""
    chance = [parents[g] * (1 - parents[g]) for g in groups]
    between = sum(n * (good / n - parents[g]) ** 2 for g, (n, good) in groups.items())
    beyond = max(0.0, (between - sum(chance)) / max(1e-9, sum(n for n, _ in groups.values())))
    strength = min(1e6, max(1.0, sum(chance) / len(chance) / beyond - 1)) if beyond > 0 else 1e6
    return {g: (good + strength * parents[g]) / (n + strength) for g, (n, good) in groups.items()}


def test_rates_and_posteriors(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang")
    rows = queries()["op2_quality_classifier"](spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    labels = labelled(spark)
    good = {d: float(q == 1 and t == 0) for d, (q, t) in labels.items()}
    known = [good[r["doc_id"]] for r in rows if r["doc_id"] in good]
    prior = min(1 - 1e-3, max(1e-3, sum(known) / len(known)))
    paths = defaultdict(lambda: [0.0, 0.0])
    for r in rows:
        d = r["doc_id"]
        chance = 1 / (1 + math.exp(-(r["evidence"] + math.log(prior / (1 - prior)))))
        weight, share = (1.0, good[d]) if d in good else (quality_model.SOFT_WEIGHT, chance)
        paths[(r["source"], r["lang"])][0] += weight
        paths[(r["source"], r["lang"])][1] += weight * share
    sites = defaultdict(lambda: [0.0, 0.0])
    for (site, _), (n, g) in paths.items():
        sites[site][0] += n
        sites[site][1] += g
    total, total_good = (sum(v[i] for v in paths.values()) for i in (0, 1))
    overall = (total_good + prior) / (total + 1)
    site_rates = shrunk(sites, dict.fromkeys(sites, overall))
    path_rates = shrunk(paths, {p: site_rates[p[0]] for p in paths})
    for r in rows:
        rate = path_rates[(r["source"], r["lang"])]
        assert r["site_rate"] == pytest.approx(site_rates[r["source"]], rel=1e-6)
        assert r["path_rate"] == pytest.approx(rate, rel=1e-6)
        score = 1 / (1 + math.exp(-(r["evidence"] + math.log(rate / (1 - rate)))))
        assert r["score"] == pytest.approx(score, abs=1e-6) and (abs(score - 0.5) < 1e-6 or r["kept"] == (score >= 0.5))


def test_toxic_documents_that_were_not_labelled(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    scored = quality_model.score(docs, labels.filter("doc_id % 3 <> 0"))
    rows = scored.join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    kept = {c: np.mean([r["kept"] for r in rows if (r["quality"], r["toxic"]) == c]) for c in ((1, 0), (1, 1), (0, 0))}
    assert kept[(1, 0)] > 0.93 and kept[(0, 0)] < 0.05
    assert kept[(1, 1)] < 0.1
