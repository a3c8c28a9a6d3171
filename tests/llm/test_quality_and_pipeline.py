"""Site quality, rules and the whole pipeline against versions in numpy and plain Python."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsflow.llm import rules, site_quality
from newsflow.llm.features import COUNTS, counts

WORD = r"[^\x20\x09-\x0D]+"


def features(text):
    c = dict(zip(COUNTS, counts(text)))
    ratio = lambda a, b: c[a] / max(c[b], 1)
    return [
        min(ratio("n_symbols", "n_words"), 1), ratio("n_upper", "n_letters"), ratio("n_repeat_words", "n_words"), ratio("n_dup_lines", "n_lines"),
        min(ratio("word_chars", "n_words"), 20), min(ratio("n_letters", "word_chars"), 1), min(ratio("n_exclaims", "n_words"), 1), ratio("n_ended", "n_lines"),
        ratio("n_distinct", "n_words"), min(ratio("n_bars", "n_words"), 1), min(ratio("n_digits", "n_words"), 1), np.log1p(c["n_words"]),
    ]


def qualities(rows, labels):
    """Quality by id, in numpy: rows of (id, text, site, path), labels of (id, 0 or 1)."""
    with_words = [(i, features(t), site, path) for i, t, site, path in rows if re.search(WORD, t or "")]
    by_id = {i: x for i, x, _, _ in with_words}
    x, y = np.array([by_id[i] for i, _ in labels if i in by_id]), np.array([float(v) for i, v in labels if i in by_id])
    weights, intercept = site_quality.fit_logistic(x, y)
    p = 1 / (1 + np.exp(-(x @ weights + intercept)))
    scaled = weights * x.std(axis=0)  # the gradient of the penalised likelihood vanishes
    assert np.abs(((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)).T @ (p - y) + scaled).max() < 1e-3
    logit = np.clip(np.array([f for _, f, _, _ in with_words]) @ weights + intercept, -12, 12)
    e = 1 / (1 + np.exp(-logit))
    sites, paths = [s for _, _, s, _ in with_words], [(s, q) for _, _, s, q in with_words]
    group = lambda keys: {k: e[[i for i, other in enumerate(keys) if other == k]] for k in set(keys)}
    by_site, by_path, n, mean = group(sites), group(paths), len(e), np.clip(e.mean(), 1e-3, 1 - 1e-3)
    within = max(sum(((v - v.mean()) ** 2).sum() for v in by_path.values()) / max(n - len(by_path), 1), 1e-6)

    def weight(groups, between, squares):
        spread = (between - (groups - 1) * within) / max(n - squares / n, 1e-9)
        return float(np.clip(within / max(spread, 1e-9), 1, 1e6))

    to_corpus = weight(len(by_site), sum(len(v) * (v.mean() - mean) ** 2 for v in by_site.values()), sum(len(v) ** 2 for v in by_site.values()))
    apart = sum(len(v) * (v.mean() - by_site[k[0]].mean()) ** 2 for k, v in by_path.items())
    to_site = weight(len(by_path) - len(by_site) + 1, apart, sum(len(v) ** 2 for v in by_path.values()))
    out = {i: 0.0 for i, _, _, _ in rows}
    for k, (i, _, site, path) in enumerate(with_words):
        of_site = (by_site[site].sum() - e[k] + to_corpus * mean) / (len(by_site[site]) - 1 + to_corpus)
        prior = np.clip((by_path[site, path].sum() - e[k] + to_site * of_site) / (len(by_path[site, path]) - 1 + to_site), 1e-3, 1 - 1e-3)
        out[i] = 1 / (1 + np.exp(-(logit[k] + np.log(prior / (1 - prior)) - np.log(mean / (1 - mean)))))
    return out


def corpus(n=90, seed=21):
    """Documents of several sites: prose, junk, near copies and personal data; and labels of half of them."""
    random = np.random.default_rng(seed)
    vocabulary = ["".join(random.choice(list("abcdefghilmnoprstu"), int(random.integers(2, 9)))) for _ in range(400)]
    prose = lambda k: " ".join(" ".join(random.choice(vocabulary, int(random.integers(5, 12)))).capitalize() + ".\n" * int(random.integers(1, 3)) for _ in range(k))
    rows, labels = [], []
    for i in range(n):
        good = random.random() < (0.9 if i % 3 else 0.4)
        text = prose(int(random.integers(2, 14))) if good else " | ".join(random.choice(["#x", "$$", "BUY", "now!", "100%"], int(random.integers(20, 60))))
        if good and i % 7 == 0:
            text += f" Mail user{i}@site{i}.example.com or 10.0.0.{i}."
        rows.append((i, text, ["a.com", "b.com", None][i % 3], ["en", "fr"][i % 2]))
        if i % 2:
            labels.append((i, int(good)))
    originals = [r for r in rows if "|" not in r[1]]
    for k in range(12):
        i, text, site, lang = originals[k]
        words = text.split(" ")
        if k % 2:
            words[len(words) // 2] = "changed"
        rows.append((200 + k, " ".join(words), "c.com", lang))
    rows += [(300, None, "a.com", "en"), (301, "", "b.com", None), (302, " \n", None, "en"), (303, prose(700), "a.com", "en")]
    return rows, labels


@pytest.fixture(scope="module")
def small(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, lang, site, len(t or "")) for i, t, site, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return rows, labels, docs, spark.createDataFrame([(i, v, 0) for i, v in labels], "doc_id long, quality int, toxic int")


def test_site_quality_equals_numpy(small):
    rows, labels, docs, given = small
    want = qualities(rows, labels)
    got = {r.doc_id: r for r in site_quality.classify(docs, given, F.col("source"), F.col("lang")).collect()}
    assert set(got) == set(want) and all(abs(got[i].quality - q) < 1e-6 for i, q in want.items())
    assert all(got[i].kept == (q >= 0.5) for i, q in want.items()) and 20 < sum(r.kept for r in got.values()) < len(rows) - 10


def test_rules_equal_a_plain_em(spark, small):
    rows, _, docs, _ = small
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    ratio = lambda a, b: a / max(b, 1)
    votes = {}
    for i, text, _, _ in rows:
        c = collections.namedtuple("C", COUNTS)(*counts(text or ""))
        many, lined, spaced = c.n_words >= 50, c.n_lines >= 3, ratio(c.n_unspaced, c.word_chars) < 0.3
        length, letters, ended, distinct, symbols = ratio(c.word_chars, c.n_words), ratio(c.n_letters, c.word_chars), ratio(c.n_ended, c.n_lines), ratio(c.n_distinct, c.n_words), ratio(c.n_symbols, c.n_words)
        bad = [
            symbols > 0.1, ratio(c.n_upper, c.n_letters) > 0.4, ratio(c.n_repeat_words, c.n_words) > 0.2, lined and ratio(c.n_dup_lines, c.n_lines) > 0.35,
            spaced and (length < 2.5 or length > 12), many and letters < 0.75, many and ratio(c.n_exclaims, c.n_words) > 0.25, many and spaced and ended < 0.2, many and distinct < 0.15,
        ]
        votes[i] = [-int(b) for b in bad] + [int(letters > 0.8 and ended > 0.5 and symbols < 0.05 and (not many or distinct > 0.3))]
    accuracy = [0.9] * 10
    for _ in range(200):
        good = {i: 1 / (1 + np.exp(-sum(v * np.log(a / (1 - a)) for v, a in zip(vs, accuracy)))) for i, vs in votes.items()}
        before = accuracy
        accuracy = []
        for j in range(10):
            right = sum(good[i] if vs[j] > 0 else 1 - good[i] for i, vs in votes.items() if vs[j])
            accuracy.append(min(0.99, max(0.55, (right + 18) / (sum(vs[j] != 0 for vs in votes.values()) + 20))))
        if max(abs(a - b) for a, b in zip(accuracy, before)) < 1e-9:
            break
    for i, vs in votes.items():
        odds = sum(v * np.log(a / (1 - a)) for v, a in zip(vs, accuracy))
        assert abs(got[i].quality - 1 / (1 + np.exp(-odds))) < 1e-6
        assert got[i].kept == (not got[i].base_failed and got[i].quality >= 0.5)


def test_scripts_without_blanks_are_no_defect(spark):
    han = "春天来了,花园里的花都开了。 孩子们在草地上奔跑,笑声传得很远! 老人坐在长椅上看书? " * 1
    lines = [f"第{n}天早晨天气很好,我们一起去山上看日出。 路上遇见了许多朋友,大家都很高兴。 {han}" for n in range(12)]
    thai = "\n".join(f"วันที่ {n} อากาศดีมากเราไปเดินเล่นที่สวนสาธารณะด้วยกัน และพบเพื่อนมากมาย" for n in range(20))
    junk = "\n".join("$$$ 100% ### |||| <<<>>> &&&&" for _ in range(20))
    rows = spark.createDataFrame([(1, "\n".join(lines)), (2, thai), (3, junk), (4, "\n".join(f"{a.capitalize()} went out, saw the {b} of {a} and came {b} home!" for a, b in zip("anna bert carl dora emil fred gina hugo ines jack".split(), "sea hill lake wood tower bridge market garden castle river".split())))], "doc_id long, text string")
    got = {r.doc_id: r for r in rules.judge(rows).collect()}
    assert got[1].quality >= 0.5 and got[2].quality >= 0.5 and not got[3].kept and got[4].quality >= 0.5


def near_duplicates(rows):
    """One row of each group linked by five-word shingles at 0.8, that of the least id."""
    sets = {}
    for i, t, *_ in rows:
        words = (t or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return [r for r in rows if root(r[0]) == r[0]]


def mixed(rows):
    """Each row as often as the mix of whole documents takes it."""
    size = {r[0]: len(re.findall(WORD, r[1] or "")) for r in rows}
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r[0]] for r in rows if r[2] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, budget, left = {}, sum(total.values()), set(sources)
    while left:
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        full = [s for s in left if 3 * total[s] <= share[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3 * total[s]
            budget -= target[s]
            left.remove(s)
    out = []
    for s in sources:
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (int(hashlib.md5(f"0:{r[0]}".encode()).hexdigest()[:15], 16), r[0]))
        epochs, rest = divmod(int(target[s] + 0.5), total[s]) if total[s] else (0, 0)
        before = 0
        for r in own:
            n = size[r[0]]
            out += [r] * (epochs + int(n > 0 and 2 * before + n < 2 * rest))
            before += n
    return out


def test_pipeline_equals_plain_python(spark, small, tmp_path):
    from tokenizers import Tokenizer

    rows, labels, docs, given = small
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    given.write.parquet(f"{tmp_path}/labels.parquet")
    quality = qualities(rows, labels)
    kept = near_duplicates([r for r in rows if quality[r[0]] >= 0.5])
    assert len(kept) < sum(q >= 0.5 for q in quality.values())
    masked = [(i, re.sub(r"\b10\.0\.0\.\d+", "[IP]", re.sub(r"user\d+@site\d+\.example\.com", "[EMAIL]", t)), s, p) for i, t, s, p in kept]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for i, text, _, _ in mixed(masked):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.update((i, k, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096)))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter(tuple(r[:5]) for r in got) == want and any(k[1] for k in want) and max(want.values()) > 1
    ends = collections.defaultdict(list)
    for r in got:
        ends[r.sequence_id].append((r.offset, r.length))
    for pieces in ends.values():
        assert sum(n for _, n in pieces) <= 4096 and all(a + n == b for (a, n), (b, _) in zip(sorted(pieces), sorted(pieces)[1:])) and min(pieces)[0] == 0
