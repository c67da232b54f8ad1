"""URL models against plain Witten-Bell sums."""

import math
import random
import re
from collections import Counter

import pytest
from lodestrata.llm import urls


def folded(host, path):
    low = re.sub("[1-9]", "0", (host + path).lower())
    return "^^^" + re.sub(r"[^a-z0\-._~/%:]", "*", low) + "$"


class Model:
    def __init__(self, texts):
        self.counts = [Counter() for _ in range(4)]
        for t in texts:
            for i in range(3, len(t)):
                for k in range(4):
                    self.counts[k][t[i - k : i + 1]] += 1

    def p(self, gram):
        out = 1 / 37
        for k in range(4):
            own = gram[3 - k :]
            followers = [c for g, c in self.counts[k].items() if g[:-1] == own[:-1]]
            if followers:
                out = (self.counts[k][own] + len(followers) * out) / (sum(followers) + len(followers))
        return out


def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        kind = i % 3
        word = "".join(rng.choice("abé" if kind else "xyz") for _ in range(rng.randrange(1, 9)))
        rows.append((i, f"h{i % 4}.{'com' if kind else 'org'}", f"/{word}/{rng.randrange(99)}" if i else "", (None, "allow", "block")[kind], 1, 2))
    return spark.createDataFrame(rows, "row long, host string, path string, verdict string, gram int, cut int").repartition(3)


def test_scores(spark):
    rows = table(spark)
    got = {r["row"]: r["score"] for r in urls.scores(rows, urls.train(rows.filter("verdict is not null")), "row").collect()}
    held = rows.collect()
    a, b = (Model(folded(r["host"], r["path"]) for r in held if r["verdict"] == v) for v in ("allow", "block"))
    for r in held:
        t = folded(r["host"], r["path"])
        grams = [t[i - 3 : i + 1] for i in range(3, len(t))]
        assert got[r["row"]] == pytest.approx(sum(math.log(a.p(g)) - math.log(b.p(g)) for g in grams) / len(grams), abs=1e-5)


@pytest.mark.parametrize("held", [False, True])
def test_cut(spark, held):
    rng = random.Random(5)
    rows = [(rng.gauss(1 if i % 2 else -1, 1), "allow" if i % 2 else "block", held and i % 3 == 0) for i in range(200)]
    got = urls.calibrate(spark.createDataFrame(rows, "score double, verdict string, held boolean"))
    use = [r for r in rows if r[2]] if held else rows
    a, b = ([r[0] for r in use if r[1] == v] for v in ("allow", "block"))

    def error(cut):
        return sum(x < cut for x in a) / len(a) + sum(x >= cut for x in b) / len(b)

    assert error(got) == pytest.approx(min(error(round(s, 2) + 0.005) for s, _, _ in use))
    assert urls.calibrate(spark.createDataFrame([r for r in rows if r[1] == "allow"], "score double, verdict string, held boolean")) == float("-inf")


def test_a_very_long_url_and_clashing_names(spark):
    rows = [(i, f"http://a{i}.org/en/{i}", 1, 2, "x", "y", 0.5) for i in range(20)] + [(20 + i, f"http://b{i}.com/de/{i}", 1, 2, "x", "y", 0.5) for i in range(20)]
    rows += [(50, "http://c.net/" + "é" * 200_000, 1, 2, "x", "y", 0.5), (51, None, 1, 2, "x", "y", 0.5), (51, None, 1, 2, "x", "y", 0.5)]
    docs = spark.createDataFrame(rows, "page_id long, url string, row int, held int, host string, verdict string, score double")
    got = urls.judge(docs).collect()
    assert len(got) == len(rows) and all(r["verdict"] in ("allow", "block") for r in got)
    assert {r["verdict"] for r in got if r["page_id"] < 20} == {"allow"} and {r["verdict"] for r in got if 20 <= r["page_id"] < 40} == {"block"}
