"""Quality counts and robust outliers against plain Python and numpy."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voxframe.llm import outliers
from voxframe.llm.queries import QUERIES


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed, len(lines)


def verdicts(rows):
    """Whether each ``(language, source, text)`` row is kept, by a dense estimate of each stratum."""
    made = [counts(r[2]) for r in rows]
    by = defaultdict(list)
    for at, (r, c) in enumerate(zip(rows, made)):
        if not c[5]:
            by[r[0], r[1]].append(at)
    strata, pools, rest = [], defaultdict(list), []
    for (language, _), found in by.items():
        (strata.append if len(found) >= 50 else pools[language].extend)(found)
    for found in pools.values():
        (strata.append if len(found) >= 50 else rest.extend)(found)
    strata += [rest] if len(rest) >= 50 else []
    kept = [not c[5] for c in made]
    for found in strata:
        x = np.array([[math.log(n), math.log(w / n), math.log1p(1000 * s / w), math.sqrt(d / m), math.sqrt(q / n)] for n, w, s, d, q, _, m in (made[i] for i in found)])
        x = np.floor(64 * x + 0.5)

        def estimate(norm):
            bins = np.floor(64 * np.log2(1 + norm)).astype(int)
            near = x[bins <= np.sort(bins)[math.ceil(0.75 * len(x)) - 1]]
            matrix = np.cov(near.T, bias=True) + 64 * np.eye(5)
            return near.mean(0), np.linalg.inv(matrix), np.linalg.slogdet(matrix)[1]

        def distances(state):
            return np.einsum("ni,ij,nj->n", x - state[0], state[1], x - state[0])

        middle = np.sort(x, 0)[(len(x) - 1) // 2]
        apart = np.sort(abs(x - middle), 0)[(len(x) - 1) // 2]
        units = abs(x - middle) / np.maximum(1.4826 * apart, 8)
        states = [estimate(n) for n in (units.sum(1), (units**2).sum(1), units.max(1))]
        for step in range(15):
            after = [estimate(distances(s)) for s in states]
            if step == 2:
                after = [min(after, key=lambda s: s[2])]
                states = states[:1]
            moved = any(b[2] - a[2] > 0.01 for a, b in zip(after, states))
            states = after
            if step > 2 and not moved:
                break
        # quantiles and probabilities of chi-squared variables with 5 and 7 degrees, from tables
        off = distances(states[0]) / (0.75 / outliers.chi_squared(6.6256798, 7))
        for at, d in zip(found, off):
            kept[at] = bool(d <= 50.692135)
    return kept


def test_chi_squared():
    for degrees, x, p in ((5, 11.0705, 0.95), (7, 14.0671, 0.95), (5, 6.62568, 0.75), (1, 3.84146, 0.95), (2, 2 * math.log(4), 0.75)):
        assert outliers.chi_squared(x, degrees) == pytest.approx(p, abs=1e-5) and outliers.chi_squared_quantile(p, degrees) == pytest.approx(x, abs=1e-3)
    assert outliers.chi_squared_quantile(outliers.CUTOFF, 5) == pytest.approx(50.692135, abs=1e-3)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    folder = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "source", "text", "doc_id").collect()]
    found = {r["doc_id"]: r for r in QUERIES["op11_quality_outliers"](spark, folder).collect()}
    assert len(found) == len(rows)
    for row, kept in zip(rows, verdicts(rows)):
        r = found[row[3]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == counts(row[2])[:6]
        assert r["kept"] == kept
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    clean = [found[k]["kept"] for k, q in labels.items() if q == 1 and k in found and not found[k]["base_failed"]]
    assert sum(clean) >= 0.99 * len(clean)


def test_a_planted_outlier_goes_whatever_the_source_holds(spark):
    draw = np.random.default_rng(5)
    names = [f"w{i}" for i in range(4_000)]
    texts = [" ".join(draw.choice(names, int(draw.integers(60, 400)), replace=False)) + "\n" for _ in range(120)]
    odd = ["# | $ * " * 3 + " ".join("#" + w for w in draw.choice(names, 80, replace=False)) for _ in range(30)]
    rows = [(i, t, "en" if i % 2 else None, None) for i, t in enumerate(texts * 2 + odd)]
    found = {r["doc_id"]: r["kept"] for r in outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(found[i] for i in range(240)) and not any(found[i] for i in range(240, 270))


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, n_words string, key int, kept string, stratum string, n int"
    texts = [None, "", " \n\t ", "a b c a b c", "\x0bé#\n\né#\n é#", "x " * 60, " ".join(f"w{i}" for i in range(60_000)), "z" * 400_000, " ".join(f"v{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))]
    rows = [(None if i % 3 == 0 else 7, t, None, "n", 1, "k", "s", 2) for i, t in enumerate(texts)]
    got = outliers.quality_digests(spark.createDataFrame(rows, schema)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[f] for f in fields) for r in got) == Counter(counts(t)[:6] for t in texts)
    assert all(r["kept"] != r["base_failed"] and r["distance"] is None for r in got)
    assert outliers.quality_digests(spark.createDataFrame([], schema)).collect() == []
