"""Filter audit, private terms and source audit on hand-made rows, against plain Python."""
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pyarrow as pa
import pytest

from tidemark.llm import filter_audit, pii, source_audit

DOCS = "doc_id long, text string, lang string, source string, part string, digest string, n long, kind int"


def documents(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*row, "p", "d", 7, 1) for row in rows], DOCS)


LONG = " ".join(f"w{i}" for i in range(120))
FILTER_ROWS = [
    (1, LONG, "en", "a"), (2, LONG, "en", "b"), (2, LONG, "en", "b"), (None, LONG, "de", "a"), (3, None, "en", "a"),
    (4, "", None, "a"), (5, "SHOUT # " * 60, "en", "a"), (6, "a " * 150, "", "a"), (7, LONG + " |", "en", "a"), (0, "SHOUT # " * 60, "de", "a"),
    (8, "x y z " * 40000, "en", "a"), (9, "ÄÖÜ " * 120, "en", "a"),
]
LABELS = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (5, 0, 1), (None, 1, 1), (7, None, 1), (99, 1, 1)]


def masks(rows):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, text, lang, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)), i is not None and i > first[text],
        ]
        yield i, lang or "", {"ABCDE"[k] for k in range(5) if fails[k]}


def test_filter_audit_equals_a_walk_through_every_order(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(documents(spark, FILTER_ROWS), labels).collect()
    good = {i for i, q, _ in LABELS if q == 1 and i is not None}
    toxic = {i for i, _, t in LABELS if t == 1 and i is not None}
    parts, wanted = defaultdict(list), {}
    for i, part, fails in masks(FILTER_ROWS):
        parts[part].append((i, fails))
    for part, rows in parts.items():
        share = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(rows)
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                share[x] += len(gone)
                wanted[part, order, step] = [
                    len(left), len(gone), sum(x in f for _, f in rows) - len(gone), sum(f == {x} for _, f in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in wanted.items():
            if p == part:
                row.append(share[order[step - 1]])
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in found}
    assert got == wanted and len(got) == 600 * len(parts)


def test_shares_are_the_shapley_values():
    factors, bottom = filter_audit.shares(4)
    worth = {s: Fraction(s * s + 3 * (s & 1)) for s in range(16)}
    for i in range(4):
        orders = list(itertools.permutations(range(4)))
        wanted = Fraction(0)
        for order in orders:
            before = sum(1 << j for j in order[: order.index(i)])
            wanted += worth[before | 1 << i] - worth[before]
        assert sum(f * worth[s] for s, f in factors[i].items()) / bottom == wanted / len(orders)


def test_audits_of_empty_tables(spark):
    none = documents(spark, FILTER_ROWS).limit(0)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).count() == 0
    assert source_audit.audit(none).count() == 0
    assert pii.find(none).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_of(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            value, number = m.group(), re.sub("[^0-9]", "", m.group())
            twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
            fits = {
                "email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else False,
                "card": 12 <= len(number) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0, "phone": 9 <= len(number) <= 15,
            }
            if fits[kind]:
                out.append((m.start(), k, m.end(), value))
    return sorted(out)


TRICKY = [
    None, "", "a@b.c_x@d.org..e@f-.g", "x.@y@z.com a+b@c.d.e.", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.000.1.09 1.1.1", "4111 1111-1111 1111 1234567890128 4111111111111112",
    "+1 (499) 555-6503 +12 +1-2-3 (+49 30 1234567.) ++1 234 567 890", "é𝄞 a.b@c.de 𝄞 10.0.0.1 \n+1 555 555 5555\n4111111111111111", "@ a@ @b.c a@b a@b. .@b.c",
    "a" * 50000, "1" * 20000, "a@" + "b." * 5000 + "c", "1 " * 5000, "+1" + " " * 5000, "a@b.c " * 300 + "x", "1.1.1.1 +1 234 567 890 " * 200,
]


def test_base_spans_equal_the_library(spark):
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(TRICKY)] + [(3, TRICKY[3], "en", "a")])
    found = pii.find(docs)
    for r in found.collect():
        assert [(s.start, s.kind, s.end, s.value) for s in r.base] == spans_of(TRICKY[r.doc_id]), TRICKY[r.doc_id]
    for r in pii.digests(found).collect():
        text = ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b, _ in spans_of(TRICKY[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.n_email == sum(k == 0 for _, k, _, _ in spans_of(TRICKY[r.doc_id]))
    assert found.count() == len(TRICKY) + 1


@pytest.mark.parametrize("n", [1, 2, 3, 10, 57])
def test_running_sums(spark, n):
    steps = [(i * 7) % 5 for i in range(n)]
    got = spark.createDataFrame([(steps,)], "s array<int>").select(pii.running(pii.F.col("s")).alias("r")).first().r
    assert got == list(itertools.accumulate(steps))


def test_terms_that_reveal_an_entity_go_wherever_they_stand(spark):
    filler = "the quick brown fox jumps over the lazy dog and more words of every day"
    rows = [(i, f"{filler} number{i}", "en", "a") for i in range(200)]
    rows += [(1000 + i, f"the Mortensen of Quarrelville writes jan@x.org today{i}", "en", "a") for i in range(4)]
    rows += [(2000, "they saw Mortensen again", "en", "a"), (2001, "Quarrington is elsewhere", "en", "a")]
    docs = documents(spark, rows)
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    names = {i: {(pii.KINDS[s.kind], s.value) for s in r.spans} for i, r in found.items()}
    assert ("removed", "Mortensen") in names[2000] and len(names[2000]) == 1
    assert {("email", "jan@x.org")} < names[1000]
    assert {v for _, v in names[1000]} >= {"Mortensen", "Quarrelville", "writes"} and not any(v == "the" for _, v in names[1000])
    assert all(not names[i] for i in range(200))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs, pii.find(docs)).collect()}
    assert clean[2000] == "they saw [REMOVED] again" and "[EMAIL]" in clean[1000] and "jan@x.org" not in clean[1000]
    assert "Quarrelville" not in clean[1000] and clean[5] == rows[5][1]


def test_source_audit_equals_dense_sums(spark):
    import random

    random.seed(3)
    vocabulary = [f"Term{chr(97 + i)}" for i in range(26)] + ["été", "ÉTÉ", "東京"]
    rows = []
    for i in range(240):
        words = random.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=random.randrange(30))
        rows.append((i, " ".join(words), random.choice(["en", "de", None]), random.choice(["s1", "s2", "s3", None])))
    rows += [(500 + i, "terma TERMA ÉTÉ " * 3, "en", "s1") for i in range(60)] + [(600, None, "en", "empty"), (601, "x", "fr", "s1"), (602, "x", "fr", "s2")]
    found = {(r.lang, r.source, r.part, r.rank): (r.item, r.value) for r in source_audit.audit(documents(spark, rows), min_docs=30, top=3).collect()}

    docs, count = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs[lang or ""].update(set(words))
        count[lang or "", source or ""].update(words)
    wanted = {}
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 30]
        sources = [s for g, s in count if g == lang]

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:3]
            for part, ranked in (("pair", pairs), ("term", terms)):
                wanted |= {(lang, s, part, k): (item, -value) for k, (value, _, item) in enumerate(ranked, 1)}
    assert found == wanted


def test_blocks_of_sources_do_not_change_distances(spark, monkeypatch):
    rows = [(i, f"common word{chr(97 + i % 3)} word{chr(97 + i % 5)}", "en", f"s{i % 9}") for i in range(90)]
    docs = documents(spark, rows)
    whole = sorted(map(tuple, source_audit.audit(docs, min_docs=2).collect()))
    entries = spark.createDataFrame(
        [("en", f"t{t}", i, 10 * t + i + 7, 7, 5) for t in range(5) for i in range(t, 9, 2)], "lang string, term string, i int, p long, z long, v long"
    )
    wanted = Counter()
    for _, a in itertools.groupby(sorted(map(tuple, entries.collect()), key=lambda r: r[1]), key=lambda r: r[1]):
        for x, y in itertools.product(list(a), repeat=2):
            wanted[x[2], y[2]] += abs(x[3] - y[3]) - abs(x[3] - 7) - abs(7 - y[3])
    got = {(r.g, r.h): r.both for r in source_audit.shared_terms(entries).collect()}
    assert {k: v for k, v in got.items() if k[0] != k[1]} == {k: v for k, v in wanted.items() if k[0] != k[1] and v}
    assert whole


@pytest.mark.parametrize("limits", [{}, {"HELD": 5}, {"HELD": 1000, "WORDS": 7, "ROWS": 3}])
def test_terms_are_counted_by_number_whatever_is_held(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(source_audit, name, value)
    random.seed(8)
    rows = [
        {"lang": random.choice(["", "en"]), "text": " ".join(random.choices(["a", "B", "b", "É", "zz9", "1", "", "x-y"], k=random.randrange(20))),
         "sources": [{"source": s, "n": random.choice([1, 3])} for s in random.sample("pqrst", random.randrange(1, 5))]}
        for _ in range(200)
    ]
    schema = pa.schema({"lang": pa.string(), "text": pa.string(), "sources": pa.list_(pa.struct({"source": pa.string(), "n": pa.int64()}))})
    n, docs = Counter(), Counter()
    for made in source_audit.count_terms(pa.RecordBatch.from_pylist(rows[at : at + 30], schema) for at in range(0, 200, 30)):
        assert made.num_rows <= source_audit.ROWS
        for r in made.to_pylist():
            n[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    wanted, seen = Counter(), Counter()
    for r in rows:
        found = source_audit.TERM.findall("".join(c.lower() if c.isascii() else c for c in r["text"]))
        for s in r["sources"]:
            for term in found:
                wanted[r["lang"], s["source"], term] += s["n"]
            for term in set(found):
                seen[r["lang"], s["source"], term] += s["n"]
    assert (n, docs) == (wanted, seen)
