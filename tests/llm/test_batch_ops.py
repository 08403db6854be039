"""Packing, personal data, notices, mixing, lines and the classifier on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayline.llm import exact, licenses, lines, mixing, packing, pii, quality

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, n_chars string, block string, score string"
ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "no id"), (5, "twice"), (5, "twice"), (6, "w " * 40000)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", "x", "x", "x") for i, t in rows], DOCS)


def real(spark, table="documents"):
    return spark.read.parquet(f"{SF}/{table}.parquet")


# --- packing ----------------------------------------------------------------
def check_packed(rows, texts):
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(held), sum(r.length for r in rows)


def test_pack(spark):
    df = real(spark).select("doc_id", "text")
    extra = [(i, t) for i, t in ODD] + [(9, "a <|endoftext|> b"), (10, "don't  stop\n\n1234 ünï ")]
    both = df.unionByName(docs(spark, extra).select("doc_id", "text"))
    texts = [tuple(r) for r in both.collect()]
    n, tokens = check_packed(packing.pack(both).collect(), texts)
    assert n <= tokens / 1024 * 1.02 + 1
    assert packing.pack(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_best_fit(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(rng.integers(1, 101, 400).tolist())
    slots = packing.plan(counts, 100)
    fill = Counter()
    for length in counts:
        own = sorted(s for s in slots if s[0] == length)
        ends = [s[1] for s in own[1:]] + [counts[length]]
        for (_, rank, first, offset), end in zip(own, ends):
            for k in range(end - rank):
                fill[first + k] += length
    assert max(fill.values()) <= 100
    rooms = []  # best-fit by single pieces
    for length in sorted(counts.elements(), reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= length]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= length
        else:
            rooms.append(100 - length)
    assert len(fill) == len(rooms)


# --- personal data ----------------------------------------------------------
def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d[::-1]))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


PLAIN = ["a@b.c@d.ef x", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
         "+1 (555) 010-9999 +12 +1234567890123456", "@x.y .@-.- a@b", "x" * 500 + "@h.i.", "1" * 500, "+1+2+3 (4)",
         "über@café.de ñ@x.com", "00000000000000 1-2 3-4"]


def test_base_spans(spark):
    texts = PLAIN + [r.text for r in real(spark).select("text").collect()]
    for text in texts:
        assert pii.find(text)[0] == base_spans(text)


@pytest.mark.parametrize("text, kind, span", [
    ("write john at example dot com now", "email", "john at example dot com"),
    ("write john (at) example [dot] com now", "email", "john (at) example [dot] com"),
    ("mail jane@example dot org.", "email", "jane@example dot org"),
    ("mail jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("mail jo​hn@exam​ple.com.", "email", "jo​hn@exam​ple.com"),
    ("ip 192 dot 168 dot 1 dot 20 ok", "ip", "192 dot 168 dot 1 dot 20"),
    ("ip １９２.１６８.１.２", "ip", "１９２.１６８.１.２"),
    ("card four one one one 1111 1111 one one one one.", "card", "four one one one 1111 1111 one one one one"),
    ("call plus one five five five zero one zero nine nine nine nine!", "phone",
     "plus one five five five zero one zero nine nine nine nine"),
])
def test_disguises(text, kind, span):
    start = text.index(span)
    assert (kind, start, start + len(span)) in pii.find(text)[1]


@pytest.mark.parametrize("kind, span, part", [
    ("email", "jоhn@example.com", "hn@example.com"),
    ("email", "jo\u200bhn@example.com", "hn@example.com"),
    ("email", "john@mail.example dot com", "john@mail.example"),
    ("email", "john@mail.example.cоm", "john@mail.example.c"),
    ("email", "john@mail.exa\u200bmple.com", None),
    ("phone", "+1 555 010 99９９", "+1 555 010 99"),
    ("phone", "+1 555 010 999\u00ad9", "+1 555 010 999"),
    ("ip", "192.168.1.2０", "192.168.1.2"),
    ("ip", "１92.168.1.20", "92.168.1.20"),
])
def test_part_found_plain_does_not_hide_the_whole(kind, span, part):
    text = f"mail x@y.org, {span}; 10.0.0.1, +44 555 010 8888"
    base, every = pii.find(text)
    start = text.index(span)
    assert base == base_spans(text) and set(base) <= set(every)
    assert (kind, start, start + len(span)) in every
    if part:
        at = text.index(part)
        assert (kind, at, at + len(part)) in base
    assert len(every) == len(set(every)) == len(base) + 1


NAMES = ("zero one two three four five six seven eight nine", "cero uno dos tres cuatro cinco seis siete ocho nueve",
         "null eins zwei drei vier fünf sechs sieben acht neun")


@pytest.mark.parametrize("dot", [" dot ", ".", " . ", " [dot] ", "(.)", "-dot-", ", dot, ", " point "])
def test_spelled_addresses(dot):
    rng = np.random.default_rng(3)
    for _ in range(200):
        names = NAMES[rng.integers(len(NAMES))].split()
        numbers = [str(rng.integers(10 ** rng.integers(1, 4))) for _ in range(4)]
        spelled = rng.random(4) < 0.7
        spelled[rng.integers(4)] = True
        words = [" -"[rng.integers(2)].join(names[int(d)] for d in n) if s else n for n, s in zip(numbers, spelled)]
        span = dot.join(words)
        text = f"the host {span} is up"
        base, every = pii.find(text)
        assert base == []
        good = all(int(n) <= 255 for n in numbers)
        assert [s for s in every if s[0] == "ip"] == [("ip", 9, 9 + len(span))] * good, text


@pytest.mark.parametrize("text, kind, span", [
    ("at one nine two dot one six eight dot one dot two zero.", "ip", "one nine two dot one six eight dot one dot two zero"),
    ("at 192 dot 168 dot one dot one now", "ip", "192 dot 168 dot one dot one"),
    ("at 192.168.1.one now", "ip", "192.168.1.one"),
    ("call plus one dot five five five dot zero one zero dot nine nine nine nine", "phone",
     "plus one dot five five five dot zero one zero dot nine nine nine nine"),
    ("mail jane at one dot two dot three dot com", "email", "jane at one dot two dot three dot com"),
    ("mail jane at one dot two dot three", "email", "jane at one dot two dot three"),
])
def test_dots_in_spelled_digits(text, kind, span):
    start = text.index(span)
    assert [s for s in pii.find(text)[1] if s[0] == kind] == [(kind, start, start + len(span))]


def test_sentences_of_digits_are_no_address():
    for text in ("One. Two. Three. Four.", "one, two, three, four", "zero point five five", "chapter one.two.three"):
        assert pii.find(text) == ([], [])


def test_plain_words_are_left_alone():
    for text in ("look at example.com or at the dot", "one two three", "We met at noon dot", "сом и кот"):
        assert pii.find(text) == ([], [])


def test_personal_data_odd_rows(spark):
    rows = pii.personal_data(docs(spark, ODD)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    assert all(r.spans == [] for r in rows)
    assert pii.personal_data(docs(spark, [])).count() == 0


# --- notices ----------------------------------------------------------------
def base_words(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


def test_notices(spark):
    texts = [t or "" for _, t in ODD] + [
        "Under THE mit license; under\nthe MIT-license", "xunder the mit license", "Apache License, Version 2.0", "CC BY-NC é CC_BY_NC",
        "under the mıt license", "undre the mit licnse", "cc by nc", "Permission is hereby grantd, free of charge, to any person obtaining a copy"]
    texts += [r.text for r in real(spark).select("text").collect()]
    rows = licenses.license_notices(docs(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, base = base_words(texts[r.doc_id])
        assert (r.n_words, [tuple(b) for b in r.base]) == (n, base)
        assert 0 <= r.score <= 1 and (r.score == 1 or not base)
        assert {b.label for b in r.base} <= {h.label for h in r.hits} or base
    by = {texts[r.doc_id]: r for r in rows}
    near = by["undre the mit licnse"] if "undre the mit licnse" in by else None
    assert near is not None and not near.base
    granted = by[texts[14]]
    assert [h.label for h in granted.hits] == ["mit"] and granted.hits[0].errors == 1
    assert (granted.hits[0].start, granted.hits[0].stop) == (0, 13)
    assert licenses.license_notices(docs(spark, [])).count() == 0


def test_notice_search_equals_full_matching():
    rng = np.random.default_rng(2)
    for _ in range(150):
        text, _, errors = licenses.NOTICES[rng.integers(len(licenses.NOTICES))]
        chars = list(text)
        for _ in range(rng.integers(0, errors + 1)):
            chars[rng.integers(1, len(chars) - 1)] = "z"
        wide = " some words " + "".join(chars) + " and more "
        k = next(k for k, n in enumerate(licenses.NOTICES) if n[0] == text)
        assert any(h[0] == k for h in licenses.scan(wide))


def test_notices_with_inserted_and_deleted_letters_equal_full_matching():
    """Every hit is a place where the whole text matches within the errors allowed, and every
    planted place is hit."""
    rng = np.random.default_rng(12)
    for _ in range(150):
        k = int(rng.integers(len(licenses.NOTICES)))
        notice, _, errors = licenses.NOTICES[k]
        chars = list(notice)
        for _ in range(int(rng.integers(0, errors + 1))):
            at, kind = int(rng.integers(1, len(chars) - 1)), int(rng.integers(3))
            if kind == 0:
                chars.insert(at, "q")
            elif kind == 1 and chars[at] != " ":
                del chars[at]
            elif chars[at] != " ":
                chars[at] = "z"
        words = [f"w{i}" for i in rng.integers(0, 50, 12)]
        wide = " " + " ".join([*words[:6], "".join(chars), *words[6:]]) + " "
        start = wide.index("".join(chars))
        whole = licenses.machine()[1][k]
        hits = [h for h in licenses.scan(wide) if h[0] == k]
        assert any(s < start + len(chars) and start < e for _, s, e, _ in hits), wide
        best = whole.search(wide)
        assert min(h[3] for h in hits) == sum(best.fuzzy_counts)
        for _, s, e, n in hits:
            assert sum(whole.fullmatch(wide, s, e).fuzzy_counts) == n <= errors


@pytest.mark.parametrize("notice, errors", [("under the mit license", 0), ("undr the mit license", 1), ("undr the mit licenze", 2)])
def test_many_notices_next_to_each_other_take_linear_time(notice, errors):
    import time
    n, start = 100_000, time.time()
    hits = [h for h in licenses.scan(f" {notice}" * n + " ") if h[0] == 0]
    assert hits == [(0, i * (len(notice) + 1) + 1, (i + 1) * (len(notice) + 1), errors) for i in range(n)]
    assert time.time() - start < 60


def test_notices_next_to_each_other():
    rng = np.random.default_rng(4)
    for k in (0, 2, 9):
        notice, _, most = licenses.NOTICES[k]
        for _ in range(40):
            errors = rng.integers(0, most + 1, 4)
            copies = []
            for e in errors:
                chars = list(notice)
                for at in rng.choice([i for i, c in enumerate(chars) if c != " "], e, replace=False):
                    chars[at] = "z"
                copies.append("".join(chars))
            wide = " " + " ".join(copies) + " "
            at = np.cumsum([1] + [len(notice) + 1] * 3)
            assert [h for h in licenses.scan(wide) if h[0] == k] == [
                (k, a, a + len(notice), e) for a, e in zip(at, errors)], wide
    assert [h[1:] for h in licenses.scan(" undr the mit license under the mit license ") if h[0] == 0] == [(1, 21, 1), (22, 43, 0)]


# --- mixing -----------------------------------------------------------------
def test_mixture(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(0, 30)), "big" if i % 20 else f"s{i % 3}") for i in range(3000)]
    rows += [(9000, "a b", None), (9001, None, "none"), (9002, "", "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(df, max_epochs=3.0).collect()
    size = Counter()
    for i, t, s in rows:
        size[s] += len((t or "").split())
    taken, docs_taken = Counter(), Counter()
    for r in out:
        taken[r.source] += r.n_tokens
        docs_taken[r.doc_id, r.epoch] += 1
    assert max(docs_taken.values()) == 1
    assert taken["big"] == size["big"] and "none" not in taken
    weights = {r.source: r.weight for r in out}
    assert abs(sum(weights.values()) - 1) < 1e-9
    budget = size["big"] / weights["big"]
    for s, w in weights.items():
        assert w * budget - 2 <= taken[s] <= w * budget + 40
        assert w * budget / size[s] <= 3.0 + 1e-6
    assert abs(max(w * budget / size[s] for s, w in weights.items()) - 3.0) < 1e-6
    assert mixing.mixed(df.limit(0)).count() == 0


def test_target_entropy_and_budget(spark):
    df = spark.createDataFrame([(i, "w " * 10, "a" if i % 10 else "b") for i in range(2000)], "doc_id long, text string, source string")
    out = mixing.mixed(df, max_epochs=None, target_entropy=0.6, budget=5000).collect()
    w = {r.source: r.weight for r in out}
    assert abs(-sum(x * np.log(x) for x in w.values()) - 0.6) < 1e-6
    assert 5000 <= sum(r.n_tokens for r in out) <= 5020


# --- lines ------------------------------------------------------------------
def test_lines(spark):
    rows = [(i, f"https://u@Site{i % 30}.org:80/x", f"<p>own {i}</p>every  where\n\n \nonly ten{'' if i % 30 < 10 else i}") for i in range(300)]
    rows += [(900, None, "every where\nown"), (901, "x", None), (902, "", ""), (None, "http://a/b", "every where")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in lines.without_spread_lines(df).collect()}
    sites = defaultdict(set)
    cut = {}
    for i, u, h in rows:
        m = re.match(r"^[^/?#]*//([^/?#@]*@)?([^/?#:]*)", u or "")
        own = re.sub(f"(?i){lines.BLOCK_END[4:]}", r"\g<0>\n", h or "").split("\n")
        cut[i] = own
        for x in own:
            sites[" ".join(x.split())].add(m[2].lower() if m else "")
    for i, own in cut.items():
        left = [x for x in own if x.strip() == "" or len(sites[" ".join(x.split())]) <= lines.MAX_SITES]
        assert got[i].kept == "\n".join(left) and got[i].n_lines == len(own) and got[i].n_removed == len(own) - len(left)
    assert lines.without_spread_lines(df.limit(0)).count() == 0


# --- exact duplicates -------------------------------------------------------
@pytest.mark.parametrize("digest", [exact.sha256, lambda t: F.substring(F.md5(t), 1, 1)])
def test_exact(spark, tmp_path, digest):
    texts = ["a b", "a  b", "a\tb", "c", None, "", " ", "\n", "é", "c", "long " * 5000, "long " * 4999 + "long ", "A b"]
    rows = list(enumerate(texts, 10)) + [(None, "a b"), (None, "n"), (None, "n"), (3, "c"), (3, "c"), (3, "other")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    out = exact.exact_groups(docs(spark, rows), digest=digest).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == want
    kept = Counter(r.text_sha256 for r in out if r.kept)
    assert kept == Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    left = exact.keep_first(docs(spark, rows), spark.createDataFrame(out)).collect()
    assert len(left) == len(groups) and len(left[0]) == 6
    assert exact.exact_groups(docs(spark, [])).count() == 0


# --- classifier -------------------------------------------------------------
def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    out = quality.quality(spark, d, labels)
    j = out.join(labels, "doc_id").where("held_out")
    right = j.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[1] > 500 and right[0] > 0.97
    assert out.where(F.col("score").isNull() | ~F.col("score").between(0, 1)).isEmpty()


def test_classifier_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1), (77, 1), (5, 1)], "doc_id long, quality int")
    out = quality.quality(spark, docs(spark, ODD), labels, bits=10).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in out)
    for i, held in ((r.doc_id, r.held_out) for r in out):
        assert held == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
    none = quality.quality(spark, docs(spark, ODD), labels.limit(0), bits=10)
    assert none.where("predicted = 1").count() == len(ODD)
    assert quality.quality(spark, docs(spark, []), labels, bits=10).count() == 0


# --- the classifier against dense arithmetic ---------------------------------
def test_ratios_equal_counts_of_documents(spark):
    """Class counts by slot, whatever the partitions, against a count in plain Python."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 40, rng.integers(1, 30))) for _ in range(120)]
    labels = [int(x) for x in rng.integers(0, 2, 120)]
    import pyarrow as pa
    from assayline.llm.common import utf8
    want = np.zeros((2, 1 << 10), np.int64)
    for t, y in zip(texts, labels):
        found, _ = quality.slots(*utf8(pa.array([t])), 10)
        want[y, found] += 1
    df = spark.createDataFrame([(i, t, y, False) for i, (t, y) in enumerate(zip(texts, labels))],
                               "doc_id long, text string, label int, fit boolean").repartition(7)
    rows = df.mapInArrow(quality.counter(10), quality.COUNTED).where("slice >= 0") \
        .groupBy("slice", "part").applyInPandas(quality.add_up, "slice int, data binary") \
        .groupBy("slice").applyInPandas(quality.add_up, "slice int, data binary").orderBy("slice").collect()
    got = np.concatenate([np.frombuffer(r["data"], np.int64).reshape(2, -1) for r in rows], axis=1)
    assert (got == want).all()


def test_counts_beyond_32_bits_do_not_wrap():
    import pandas as pd
    big = np.array([2**31 - 1, 5, 2**40, 0], np.int64).tobytes()
    out = quality.add_up(pd.DataFrame({"slice": [0, 0, 0], "data": [big] * 3}))
    assert np.frombuffer(out["data"][0], np.int64).tolist() == [3 * (2**31 - 1), 15, 3 * 2**40, 0]


def test_dual_solution_equals_a_dense_solver():
    """The multipliers' dual objective, maximised by projected gradient on the dense kernel, gives
    the weights that coordinate descent finds."""
    rng = np.random.default_rng(3)
    size, n = 60, 200
    rows = [np.unique(rng.integers(0, size, 8)) for _ in range(n)]
    y = np.where([(3 in r) + (7 in r) - (11 in r) > rng.normal(0, 0.4) for r in rows], 1.0, -1.0)
    ratio = rng.normal(size=size)
    dense = np.array([np.isin(np.arange(size), r) for r in rows]) * ratio
    weight = np.where(y > 0, 1.0, max(1.0, min(10.0, (y > 0).sum() / max(1, (y < 0).sum()))))
    kernel = (dense @ dense.T + 1) * np.outer(y, y)
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(kernel)[-1]
    momentum, before = alpha.copy(), 1.0
    for _ in range(60_000):
        new = np.clip(momentum + step * (1 - kernel @ momentum), 0, quality.COST * weight)
        after = (1 + math.sqrt(1 + 4 * before**2)) / 2
        momentum, alpha, before = new + (before - 1) / after * (new - alpha), new, after
    want = dense.T @ (alpha * y)
    model = quality.fit_model(rows, y, ratio, beta=1.0, passes=4000)
    assert np.allclose(model[:-3], want * ratio, atol=2e-3)
    assert abs(model[-3] - (alpha * y).sum()) < 2e-3
