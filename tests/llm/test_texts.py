"""Licence scan, chat format, personal data, decontamination, toxicity and scores against brute force."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import chat, decontam, licenses, lm_score, pii, toxicity
from tests.llm.conftest import EDGES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


LICENSED = [
    (20, "Under the MIT License, under  the mit-license; and CC BY-NC 4.0."), (21, "the MIT license under the Mit"),
    (22, "Licensed under the GNU General Public License, version 3."), (23, "apache\nlicense\tVERSION 2 under the MİT license"),
    (24, "cc by nc by nc cc by nc nc"), (25, "Licensed under the Apache License, Version 2.0 (the License)"), (26, "under the mit " * 500 + "license"),
]


def test_license_base_places(spark, docs):
    rows = [*EDGES, *LICENSED]
    got = licenses.report(licenses.scan(docs(rows))).collect()
    base = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    want = []
    for i, t in rows:
        w = words(t)
        found = sorted((k, label) for label, p in base.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        places = [k for k, _ in found]
        want.append((i, len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({b for _, b in found}))))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in got}
    assert by_id[22].labels == "gpl-3" and by_id[22].base_labels == "" and by_id[22].score == 1.0
    assert by_id[20].labels == "cc-by-nc,mit" and by_id[3].score == 0.0 and all(0 <= r.score <= 1 for r in got)


def test_license_needs_the_key_phrase(spark, docs):
    """All other words of a template don't make up for its mandatory phrase."""
    rows = [(1, "licensed under the gnu general private license version 3"), (2, "gnu general public license version 3")]
    got = {r.doc_id: r.labels for r in licenses.report(licenses.scan(docs(rows))).collect()}
    assert got == {1: "", 2: "gpl-3"}


def test_license_empty_table(spark, docs):
    assert licenses.report(licenses.scan(docs([]).limit(0))).collect() == []


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "assistant", None), (1, 3, "user", "<|turn|>x<|end|>\n<|next|> \u001b0 \u001ba \u001b"),
    (2, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 0, None, "who"), (None, 0, "user", "lost"), (None, 0, "assistant", ""), (3, None, "user", "first"),
    (3, 5, "ro\nle", "é\U0001f600"), (3, 5, "ro\nle", "é\U0001f600"), (4, 0, "user", "<|tur<|turn|>n|><|next|>"), *((5, t, "assistant", f"t{t}") for t in range(30)),
]


@pytest.mark.parametrize("slice_turns", [512, 4])
def test_chats_are_read_back(spark, slice_turns):
    turns = spark.createDataFrame([(*t, 1) for t in TURNS], "conv_id bigint, turn bigint, role string, text string, k int").repartition(3)
    formatted = chat.format_chats(turns, slice_turns=slice_turns)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    groups = defaultdict(list)
    for c, t, role, text in TURNS:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(groups)
    for c, rows in groups.items():
        listed = [(role, text) for _, _, role, text in sorted(rows)]
        learned = "".join(t for r, t in listed if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for r, t in listed)
        assert got[c].n_turns == len(rows) and got[c].loss_chars == len(learned)
        assert got[c].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    texts = {r.conv_id: r for r in formatted.collect()}
    assert all(got[c].formatted_chars == len(r.formatted) for c, r in texts.items())
    assert texts[1].n_blocks == 3 and texts[5].n_blocks == 1 and "[INST]" not in texts[2].formatted
    assert chat.digests(chat.format_chats(turns.limit(0))).collect() == []


def luhn(digits):
    return sum((d := int(c) * (1 + i % 2)) - 9 * (d > 9) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_by_pattern(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, fine) in enumerate(kinds) for m in re.finditer(p, text) if fine(m.group()))


def test_patterns_like_plain_regular_expressions():
    pick = random.Random(8)
    for _ in range(4000):
        text = "".join(pick.choice("aA@@..-+ 0123()%_9\né") for _ in range(pick.randrange(45)))
        assert pii.base_spans(text) == base_by_pattern(text), repr(text)
    for text in ("a@b@c.d", "x.y@q..z@a.b-c", "1.2.3.4.5.6.7.8.9", "4444 4444-4444 4448", "+1 (2) 3456789 +", "é@a.b", "@a.b@c.d", "0000255.1.1.1"):
        assert pii.base_spans(text) == base_by_pattern(text)
    # long runs that a backtracking search would take too long for
    for text in ("1" * 200_000, "a" * 200_000, "a@" * 50_000, "1." * 50_000, "+1" + " " * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def planted():
    """An address that always stands beside a rare surname, among texts that share everything else."""
    rows = [(300 + i, f"Write to Zorblatt at z@secret.org today, note {i} of all.") for i in range(1, 6)]
    rows += [(310 + i, f"Nothing to write today, note {i} of all.") for i in range(60)]
    return rows + [(390, "Call +1 (555) 555-1234 today."), (391, "today Zorblatt")]


def disclosed(rows, s=pii.Settings()):
    """(entity, term) to disclosure, by counting."""
    near, texts, n_e, n_t = Counter(), defaultdict(set), Counter(), Counter()
    for _, t in rows:
        t = t or ""
        found = {(e, w) for e, w, _, _ in pii.contexts(t, pii.base_spans(t), s.reach)}
        near.update(found), n_e.update({e for e, _ in found}), n_t.update(set(pii._TERM.findall(t.lower())))
        for x in found:
            texts[x].add(t)
    n = len(rows)
    return {
        (e, w): math.log(c * n / (n_t[w] * n_e[e])) / math.log(n / n_e[e])
        for (e, w), c in near.items() if len(texts[e, w]) >= s.support and n_e[e] < n
    }


def test_terms_that_give_an_entity_away(spark, docs):
    rows = [*EDGES, *planted()]
    got = pii.find_spans(docs(rows)).collect()
    want = {x: d for x, d in disclosed(rows).items() if round(d, 9) >= 0.7}
    assert ("email:z@secret.org", "zorblatt") in want and ("email:z@secret.org", "today") not in want
    for r, t in ((r, dict(rows).get(r.doc_id) or "") for r in got if r.doc_id is not None and r.doc_id > 1):
        base = base_by_pattern(t)
        assert [tuple(s) for s in r.base] == base
        near = pii.contexts(t, base, pii.Settings().reach)
        terms = {(a, 4 if want[e, w] >= 0.9 else 5, b) for e, w, a, b in near if (e, w) in want}
        assert [tuple(s) for s in r.spans] == sorted([*base, *terms])
    told = pii.report(pii.find_spans(docs(planted()))).collect()
    assert all(r.n_email == (r.doc_id < 306) and r.n_phone == (r.doc_id == 390) for r in told)
    assert pii.report(pii.find_spans(docs([]).limit(0))).collect() == []


def test_covered_texts(spark, docs):
    rows = [*EDGES, *planted()]
    source = docs(rows)
    out = pii.sanitise(source, length="n_chars")
    assert out.columns == source.columns and out.count() == len(rows)
    text = {r.doc_id: r for r in out.collect()}
    assert "z@secret" not in text[302].text and "zorblatt" not in text[302].text.lower() and "[EMAIL]" in text[302].text
    assert text[390].text == "Call [PHONE] today." and text[313].text == "Nothing to write today, note 3 of all."
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
    assert pii.cover("abcdef", [(1, 0, 3), (2, 1, 5)]) == "a[EMAIL]f"


def test_terms_of_entities_of_one_text(spark, docs):
    """Each address stands in one text only; its owner's rare name discloses it all the same, common words do not."""
    rows = [(i, f"nothing to say about plain things {i}") for i in range(300)]
    rows += [(1000 + i, f"plain things say {name} to {name.lower()}@mail{i}.org") for i, name in enumerate(("Zorblatt", "Quimby"))]
    got = {r.doc_id: r for r in pii.find_spans(docs(rows)).collect()}
    for i, name in ((1000, "Zorblatt"), (1001, "Quimby")):
        text = dict(rows)[i]
        assert [tuple(s)[1:2] + (text[s.start:s.end],) for s in got[i].spans if s.kind > 3] == [(5, name)]


def test_terms_on_other_lines_and_far_away(spark, docs):
    rows = [(300 + i, f"Zorblatt\nnote {'filler ' * 40}\nz@secret.org\n{'filler ' * 40} by zorblatt {i}") for i in range(1, 6)]
    rows += [(310 + i, f"note filler by none {i}") for i in range(60)]
    for r in pii.find_spans(docs(rows)).collect():
        text = dict(rows)[r.doc_id]
        assert [text[s.start:s.end] for s in r.spans if s.kind > 3] == (["Zorblatt", "zorblatt"] if r.doc_id < 310 else [])
    text = {r.doc_id: r.text for r in pii.sanitise(docs(rows), length="n_chars").collect()}
    assert all("zorblatt" not in text[i].lower() and "[EMAIL]" in text[i] for i in range(301, 306))


def test_entities_without_words_around_them_count(spark, docs):
    """n(e) takes rows that hold nothing but the entity, so the name tells little of it."""
    rows = [(i, f"Zorblatt z@secret.org {i}") for i in range(3)] + [(100 + i, f"z@secret.org {i}") for i in range(40)]
    rows += [(200 + i, f"none {i}") for i in range(40)] + [(300, "zorblatt")]
    assert math.log(3 * 84 / (4 * 43)) / math.log(84 / 43) < 0.7 < 0.9 < math.log(3 * 84 / (4 * 3)) / math.log(84 / 3)
    assert {s.kind for r in pii.find_spans(docs(rows)).collect() for s in r.spans} == {0}


def tiles_by_hand(a, b, least):
    """Greedy string tiling by comparing every pair of places."""
    free_a, free_b, total = [True] * len(a), [True] * len(b), 0
    while True:
        best, found = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] != 0 and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best >= least:
                    found.append((i, j))
        if best < least:
            return total
        for i, j in found:
            if all(free_a[i:i + best]) and all(free_b[j:j + best]):
                free_a[i:i + best], free_b[j:j + best] = [False] * best, [False] * best
                total += best


def test_tiles_by_hand():
    pick = random.Random(2)
    for _ in range(300):
        a = [pick.randrange(1, 4) for _ in range(pick.randrange(1, 25))]
        b = [pick.randrange(0, 4) for _ in range(pick.randrange(1, 40))]
        tiles = decontam.greedy_tiles(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), 2)
        assert sum(t[2] for t in tiles) == tiles_by_hand(a, b, 2)
        assert all(a[i:i + n] == b[j:j + n] and n >= 2 for i, j, n in tiles)


def test_benchmark_passages(spark, docs):
    pick = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(pick.choices(vocabulary, k=pick.randrange(6, 40)))) for k in range(8)] + [(8, "too short"), (9, None), (10, "")]
    rows = list(EDGES)
    for k in range(40):
        text = pick.choices(vocabulary, k=80)
        item = items[k % 8][1].split()
        if k % 4 == 0:
            text[30:30] = item
        elif k % 4 == 1:  # halves the other way round
            text[10:10] = item[len(item) // 2:]
            text[60:60] = item[: len(item) // 2]
        elif k % 4 == 2:
            text[20:20] = item[: len(item) // 2]
        rows.append((100 + k, ", ".join(text).upper() if k % 5 else " ".join(text)))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, stretch int")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontam.contaminated(docs(rows), bench, ["doc_id"]).collect()}
    want = {}
    for i, t in rows:
        for k, item in items:
            a, b = words(item), words(t)
            if a and (share := tiles_by_hand(a, b, min(5, len(a))) / len(a)) >= 0.8:
                want[i, k] = share
    assert got == pytest.approx(want) and len(want) >= 15
    source = docs(rows)
    kept = decontam.keep_clean(source, bench)
    assert kept.columns == source.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in rows if i not in {d for d, _ in want}), key=repr)
    assert decontam.contaminated(docs([]).limit(0), bench, ["doc_id"]).collect() == []
    assert decontam.contaminated(source, bench.limit(0), ["doc_id"]).collect() == []


def test_short_items_and_clashing_names(spark):
    """Items of one to four words are found word for word; columns with the operator's own names keep their values."""
    names = ["keys", "words", "seeds", "stretch", "item", "digest", "digest_", "__text_key", "__text"]
    texts = [(1, "Say plain  words HERE, now"), (2, "plain words are not here"), (3, "here"), (4, "one two three four five"), (5, ""), (6, None), (7, "two, three")]
    docs = spark.createDataFrame([(i, t, *names) for i, t in texts], ["doc_id", "text", *names]).repartition(2)
    items = [(10, "plain words here"), (11, "Two three"), (12, "four five six"), (13, "here"), (14, ""), (15, None), (16, "a b c d e f g")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(tuple(r) for r in decontam.contaminated(docs, bench, ["doc_id", "item"]).select("doc_id", "item", "item_id", "coverage", "n_tiles").collect())
    want = [(1, 10), (1, 13), (2, 13), (3, 13), (4, 11), (7, 11)]
    assert got == [(d, "item", k, 1.0, 1) for d, k in want]
    assert sorted(map(tuple, decontam.keep_clean(docs, bench).collect())) == [(5, "", *names), (6, None, *names)]


def test_words_of_one_text_do_not_disclose(spark):
    """What is unique to a text with an entity stays, unless the entity spells it; other columns keep their values."""
    names = ["terms", "__key", "__new", "key", "digest", "new_text", "told", "unit"]
    rows = [(i, f"unique{chr(97 + i % 26)}{chr(97 + i // 26)}x thing by quimby to quimby.{i}@mail{i}.org") for i in range(2)]
    rows += [(i, f"only{chr(97 + i % 26)}{chr(97 + i // 26)}y thing {i}") for i in range(2, 300)]
    docs = spark.createDataFrame([(i, t, *names) for i, t in rows], ["doc_id", "text", *names]).repartition(2)
    found = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    for i in (0, 1):
        assert [rows[i][1][s.start:s.end] for s in found[i].spans if s.kind > 3] == ["quimby"]
    out = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert out[0].text == "uniqueaax thing by [GENERAL] to [EMAIL]" and all(tuple(r)[2:] == tuple(names) for r in out.values()) and len(out) == 300


def test_a_text_with_very_many_addresses(spark, docs):
    """1,500 addresses beside 8,000 words are no product of both."""
    letters = [chr(97 + k) for k in range(26)]
    many = " ".join(f"p{k}@host{k}.org" for k in range(1500)) + " " + " ".join("w" + letters[k % 26] + letters[k // 26 % 26] + letters[k // 676] for k in range(8000))
    rows = [(0, many)] + [(i, f"note {i}") for i in range(1, 51)]
    began = time.time()
    (row,) = pii.report(pii.find_spans(docs(rows))).where("doc_id = 0").collect()
    assert row.n_email == 1500 and time.time() - began < 60


def toxic_rows(n):
    pick = random.Random(n)
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        text = pick.choices([f"plain{k}" for k in range(300)], k=40)
        for at in pick.sample(range(40), 3 if bad else 0):
            text[at] = pick.choice(["Vileword", "grubtalk", "grubbish", "scornful"])
        rows.append((i, " ".join(text)))
        labels.append((i, None if i % 50 == 3 else int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, docs):
    rows, labels = toxic_rows(1500)
    held = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    source = docs([*rows, *((10_000 + (i or 0), t) for i, t in EDGES)])
    model = toxicity.learn(source, held)
    got = {r.doc_id: r for r in toxicity.score_texts(source, model).collect()}
    assert len(got) == len(rows) + len({i for i, _ in EDGES})
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    tried = [(got[i].predicted, y) for i, y in labels if y is not None and got[i].held_out]
    assert len(tried) > 200 and sum(p == y for p, y in tried) >= 0.99 * len(tried)
    assert not any(got[i].predicted for i in got if i >= 10_000)
    clean = toxicity.keep_clean(source, model)
    assert clean.columns == source.columns and {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if not r.predicted}


def test_toxicity_never_sees_the_held_out_fold(spark, docs):
    rows, labels = toxic_rows(600)
    held = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    flipped = held.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(docs(rows), held), toxicity.learn(docs(rows), flipped)
    assert a.weights == b.weights and a.bias == b.bias and a.weights


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.learn(docs(EDGES), none)
    assert {r.score for r in toxicity.score_texts(docs(EDGES), model).collect()} == {0.0}
    assert toxicity.score_texts(docs([]).limit(0), model).collect() == []


@pytest.mark.parametrize("vocabulary,frequent", [(lm_score.VOCABULARY, 512), (5, 2), (lm_score.VOCABULARY, 0)])
def test_scores_by_counting(spark, docs, vocabulary, frequent):
    pick = random.Random(6)
    rows = [*EDGES, *((100 + i, " ".join(pick.choices("the of and cat dog sat".split(), k=pick.randrange(1, 30)))) for i in range(40))]
    split = [words(t) for _, t in rows]
    raw = Counter(w for x in split for w in x)
    import xxhash

    def signed(w):
        h = xxhash.xxh64_intdigest(w.encode())
        return h - (1 << 64) if h >> 63 else h

    named = set(sorted(raw, key=lambda w: (-raw[w], signed(w)))[:vocabulary])
    split = [[w if w in named else "?" for w in x] for x in split]
    one, two, total = Counter(w for x in split for w in x), Counter(p for x in split for p in zip(["", *x], x)), sum(raw.values())
    one[""] = sum(bool(x) for x in split)
    want = []
    for (i, _), x in zip(rows, split):
        s = 0.0
        for (v, w), n in Counter(zip(["", *x], x)).items():
            seen = two[v, w] - n
            s += n * math.log(seen / (one[v] - n) if seen else lm_score.BACKOFF * max(1, one[w] - n) / total)
        want.append((i, len(x), s / len(x) if x else None))
    got = lm_score.score_texts(docs(rows), vocabulary=vocabulary, frequent=frequent).collect()
    for have, due in zip(sorted(map(tuple, got), key=repr), sorted(want, key=repr)):
        assert have[:2] == due[:2] and have[2] == (None if due[2] is None else pytest.approx(due[2], abs=2e-6))
    assert len(got) == len(want)
    assert lm_score.score_texts(docs([]).limit(0)).collect() == []


def test_rare_words_keep_their_counts(spark, docs, monkeypatch):
    """With only four short ids every other word still has counts of its own."""
    monkeypatch.setattr(lm_score, "NAMED", 4)
    pick = random.Random(16)
    rows = [(i, " ".join(pick.choices([f"w{k}" for k in range(60)], k=40))) for i in range(30)] + [(99, "never seen words"), (98, None)]
    split = [words(t) for _, t in rows]
    one, two = Counter(w for x in split for w in x), Counter(p for x in split for p in zip(["", *x], x))
    one[""], total = sum(bool(x) for x in split), sum(len(x) for x in split)
    got = {r.doc_id: r for r in lm_score.score_texts(docs(rows), frequent=2).collect()}
    for (i, _), x in zip(rows, split):
        s = 0.0
        for (v, w), n in Counter(zip(["", *x], x)).items():
            seen = two[v, w] - n
            s += n * math.log(seen / (one[v] - n) if seen else lm_score.BACKOFF * max(1, one[w] - n) / total)
        assert got[i].score == (pytest.approx(s / len(x), abs=2e-6) if x else None)


def test_pairs_with_rare_words_travel_packed(spark, docs, monkeypatch):
    """Neither scratch tables nor what is sent have a row for each pair, however rare its words."""
    monkeypatch.setattr(lm_score, "NAMED", 4)
    pick = random.Random(17)
    rows = [(i, " ".join(pick.choices([f"w{k}" for k in range(60)], k=40))) for i in range(30)]
    written, plain = [], lm_score.write_scratch
    monkeypatch.setattr(lm_score, "write_scratch", lambda df, label: written.append(plain(df, label)) or written[-1])
    scores = lm_score.score_texts(docs(rows), frequent=2)
    assert scores.count() == 30 and "Window" not in scores._jdf.queryExecution().toString()
    assert sum(df.count() for df in written) < 100


def test_packed_columns(spark):
    import numpy as np

    for columns in ([[0, 255], [], [256], [-1, -(2**63), 5]], [[], [], [], []], [[2**40], [1], [65_535], [65_536]]):
        arrays = [np.array(c, dtype=np.int64) for c in columns]
        assert [c.tolist() for c in lm_score._unpack(lm_score._pack(*arrays), 4)] == columns


def test_scores_by_counting_with_many_parts(docs, monkeypatch):
    """One part and many give the same scores, also for pairs of two rare words in different texts and groups."""
    monkeypatch.setattr(lm_score, "NAMED", 3)
    pick = random.Random(18)
    rows = [(i, " ".join(pick.choices([f"w{k}" for k in range(40)], k=pick.randrange(30)))) for i in range(60)]
    found = []
    for part in (10**6, 7):
        monkeypatch.setattr(lm_score, "PART", part)
        found.append(sorted(map(tuple, lm_score.score_texts(docs(rows), frequent=2).collect())))
    assert found[0] == found[1] and len(found[0]) == 60
