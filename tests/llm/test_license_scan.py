import random

from tidepool.llm import license_scan as L
from tidepool.llm.queries import QUERIES


def plain_lis(values):
    best = [1] * len(values)
    for i in range(len(values)):
        for j in range(i):
            if values[j] < values[i]:
                best[i] = max(best[i], best[j] + 1)
    return max(best, default=0)


def plain_align(a, b):
    """The number of aligned words, by recursion and with a quadratic subsequence search."""
    n = 0
    while a and b and a[0] == b[0]:
        a, b, n = a[1:], b[1:], n + 1
    while a and b and a[-1] == b[-1]:
        a, b, n = a[:-1], b[:-1], n + 1
    unique = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 and b.count(w) == 1]
    return n, plain_lis([j for _, j in unique]), bool(unique)


def test_alignment():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))
        ends, anchors, _ = plain_align(a, b)
        assert len(pairs) >= ends + anchors
        values = [rng.randrange(9) for _ in range(12)]
        found = [values[i] for i in L.increasing(values)]
        assert len(found) == plain_lis(values) and found == sorted(set(found))


def test_common_words():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = L.common(a, b)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))


def test_scan(docs_of):
    filler = " ".join(f"zz{i}" for i in range(500))
    mit = L.TEMPLATES["MIT-text"]
    rows = {1: (f"{filler}\n{mit.upper()}\n{filler}", "MIT-text", 1.0), 2: (mit.replace("free of charge", "gratis"), "MIT-text", None),
            3: ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 1.0), 4: ("licensed under cc by 4.0", "CC-BY-4.0", 1.0), 5: (filler, None, 0.0),
            6: (None, None, 0.0), 7: ("", None, 0.0), 8: ("under the License, released MIT", None, 0.0),
            9: (" ".join(["Released under the MIT License."] * 5 + [filler, "Released under the MIT License"]), "MIT", 1.0)}
    got = L.scan_licenses(docs_of([(i, t[0], "s", 1) for i, t in rows.items()] + [(3, rows[3][0], "s", 1)], "license int")).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        _, name, share = rows[r.doc_id]
        assert r.license == name, r
        assert r.coverage == share if share is not None else 0.8 <= r.coverage < 1
    first = next(r for r in got if r.doc_id == 1)
    assert (first.first_word, first.end_word) == (500, 500 + len(L.word_list(mit.encode())))
    assert L.scan_licenses(docs_of([])).collect() == []


def test_query_finds_every_notice(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.license for r in QUERIES["op7_license_scan"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        named = [n for n in sorted(L.TEMPLATES, key=lambda n: -len(L.TEMPLATES[n])) if L.TEMPLATES[n].lower() in (r.text or "").lower()]
        assert got[r.doc_id] == (named[0] if named else None)


def test_inserted_words_at_every_offset():
    for name in ("MIT-text", "Apache-2.0-header"):
        t = L.word_list(L.TEMPLATES[name].encode())
        n = len(t)
        for share in (0.5, 1.0):
            new = [b"zz%d" % i for i in range(round(share * n))]
            middle = t[:n // 2 + 1] + new + t[n // 2 + 1:]
            for offset in range(0, 2 * n, 7):
                before = [b"yy%d" % i for i in range(offset)]
                assert L.copies(before + middle + before, t, 0.8) == [(1.0, offset, offset + len(middle))], (name, share, offset)
        between = [w for i, x in enumerate(t) for w in (x, b"zz%d" % i)]
        assert L.copies(between + t, t, 0.8) == [(1.0, 0, 2 * n - 1), (1.0, 2 * n, 3 * n)]


def test_every_license_is_found_by_its_own_name(spark, docs_of):
    filler = " ".join(f"zz{i}" for i in range(300))
    names = sorted(L.TEMPLATES)
    texts = [L.TEMPLATES[n] for n in names]
    bsd = L.TEMPLATES["BSD-3-Clause"].replace("the copyright holder nor", "Some Company nor")
    texts += ["It is free under the GNU Lesser Public License", "Licensed under CC BY-XX 4.0", f"{texts[names.index('MIT-text')]}\n{filler}\n{texts[names.index('GPL-3.0')]}",
              bsd, "This work is licensed under the GNU Foreign General Public License, version 3"]
    got = {r.doc_id: r for r in L.scan_licenses(docs_of(list(enumerate(texts)))).collect()}
    for i, n in enumerate(names):
        assert got[i].license == n and got[i].coverage == 1.0 and [x.license for x in got[i].licenses] == [n], (n, got[i])
    at = len(names)
    assert got[at].license is None and got[at].licenses == [] and got[at + 1].license is None and got[at + 4].license is None
    both = got[at + 2].licenses
    assert [x.license for x in both] == ["MIT-text", "GPL-3.0"] and both[1].first_word == both[0].end_word + 300
    assert [x.license for x in got[at + 3].licenses] == ["BSD-3-Clause"]
    table = spark.createDataFrame([("Own", "You may use this as you like"), ("None", None)], "license string, text string")
    own = L.scan_licenses(docs_of([(1, "Well, you may use this, as you like.")]), table).first()
    assert own.license == "Own" and own.coverage == 1.0


def with_phrases(t, n, rng):
    """A copy of ``t`` with ``n`` of its early phrases inserted, all its words still in order."""
    out = list(t)
    for place in sorted((rng.randrange(8, len(t) - 8) for _ in range(n)), reverse=True):
        p = rng.randrange(0, len(t) // 3)
        out[place:place] = t[p:p + 6]
    return out


def test_any_number_of_inserted_phrases_and_copies():
    rng = random.Random(3)
    for name in ("MIT-text", "Apache-2.0-header"):
        t = L.word_list(L.TEMPLATES[name].encode())
        for inserted in (0, 1, 2, 4, 6, 9, 13, 20):
            for n in range(1, 6):
                parts = [with_phrases(t, inserted, rng) for _ in range(n)]
                assert [len(L.align(x, t)) for x in parts] == [len(t)] * n
                got = L.copies([w for x in parts for w in x], t, 0.8)
                assert [g[0] for g in got] == [1.0] * n, (name, inserted, n, got)


def test_least_spans_equal_a_plain_count():
    rng = random.Random(4)
    for _ in range(200):
        t = [rng.choice("abcde") for _ in range(6)]
        region = [rng.choice("abcde") for _ in range(rng.randrange(1, 30))]
        cuts = [0, *sorted(rng.sample(range(1, len(region)), min(5, len(region) - 1))), len(region)]
        n, least = len(cuts) - 1, rng.randrange(1, 7)
        holds = lambda i, j: sum((L.Counter(region[cuts[i]:cuts[j]]) & L.Counter(t)).values()) >= least
        want = [next((j for j in range(i + 1, n + 1) if holds(i, j)), n + 1) for i in range(n)]
        assert L.reach(region, cuts, t, least) == want


def test_many_notices_take_time_in_proportion():
    import time
    notice = L.word_list(b"Released under the MIT License")
    templates = {"MIT": notice}
    times = []
    for n in (20_000, 100_000):
        begin = time.process_time()
        assert len(L.all_matches(notice * n, ["MIT"], templates, 0.8)) == n
        times.append(time.process_time() - begin)
    assert times[1] < 12 * times[0]


def test_a_large_template_table_and_texts_of_one_letter():
    import resource

    import pyarrow as pa
    rng = random.Random(5)
    templates = {f"l{i}": [b"w%d" % rng.randrange(20_000) for _ in range(300)] for i in range(600)}
    templates["a"] = [b"a"]
    run = L._scan(templates, 0.8)
    texts = ["a"] * 200_000 + [" ".join(w.decode() for w in templates["l7"])]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    out = next(run([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])]))
    assert out.column(1).to_pylist()[-1] == "l7" and out.column(1).to_pylist()[:200_000] == ["a"] * 200_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_500_000  # kB
