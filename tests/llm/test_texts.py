import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.llm import language, licenses, mixing, pseudonyms, toxicity
from riskloom.llm.catalog import ORACLES, QUERIES
from tests.compare import compare, connect


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def pseudonymised(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, found int")
    out = pseudonyms.pseudonymise(df, key=key, count="n")
    assert out.columns == ["doc_id", "text", "found", "n"]
    return [(r.text, r.n) for r in out.orderBy("doc_id").collect()]


def test_pseudonyms_keep_format_and_links(shared):
    got = pseudonymised(
        shared,
        [
            "4041894974608795 4041-8949-7460-8795",
            "+1 (988) 555-2485, 988.555.2485",
            "2024-02-29 29.02.2024 02/29/2024",
            "a.b42@mail8.example.com A.B42@mail8.example.com",
            "70.123.182.155",
            "123-45-6789",
            "DE89 3704 0044 0532 0130 00 DE89370400440532013000",
        ],
    )
    card, spaced = got[0][0].split()
    assert card == spaced.replace("-", "") != "4041894974608795" and luhn(card)
    phones = [p[-12:].replace(")", "").replace(" ", "-").replace(".", "-").strip("-(") for p in got[1][0].split(", ")]
    assert len({"".join(c for c in p if c.isdigit())[-10:] for p in got[1][0].split(", ")}) == 1 and phones
    iso, dotted, slashed = got[2][0].split()
    assert iso.split("-") == dotted.split(".")[::-1] == [slashed[6:], slashed[:2], slashed[3:5]]
    assert len(set(got[3][0].split())) == 1 and got[3][0].endswith(".com")
    assert all(0 <= int(x) < 256 for x in got[4][0].split("."))
    assert got[6][0].replace(" ", "")[:22] == got[6][0].replace(" ", "")[22:]
    iban = got[6][0].split(" ")[-1]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert [n for _, n in got] == [2, 2, 3, 2, 1, 1, 2]


def test_what_is_no_personal_value_stays(shared):
    texts = [None, "", "plain", "Version 2.0. 1.2.3", "4041894974608796", "2024-02-30", "300.1.1.1", "666-12-1234", "12 345-6789"]
    assert pseudonymised(shared, texts) == [(t, 0) for t in texts]


def test_phones_of_any_area_and_exchange(shared):
    numbers = ["0175557713", "1325551352", "0000000000", "1999991234", "9880551234", "2001990000", "9885552485", "2002000000"]
    got = pseudonymised(shared, [f"+1 ({n[:3]}) {n[3:6]}-{n[6:]} or {n[:3]}.{n[3:6]}.{n[6:]}" for n in numbers])
    new = []
    for n, (text, count) in zip(numbers, got, strict=True):
        first, second = ("".join(c for c in p if c.isdigit()) for p in text.split(" or "))
        assert count == 2 and first == "1" + second and second != n and len(second) == 10
        assert (min(n[:3], n[3:6]) >= "200") == (min(second[:3], second[3:6]) >= "200")
        new.append(second)
    assert len(set(new)) == len(new)


def test_secrets_are_replaced_whole(shared):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-"
    head, payload, signature, long = ("".join(rng.choices(letters, k=n)) for n in (36, 120, 43, 20_000))
    texts = [f"token={head}.{payload}.{signature}. End", f"api_key: '{long[:300]}' end", f"secret={long}", "password=short12. password=long1234."]
    got = pseudonymised(shared, texts)
    jwt = got[0][0][len("token=") : -len(". End")]
    assert got[0][1] == 1 and got[0][0].endswith(". End") and [len(p) for p in jwt.split(".")] == [36, 120, 43]
    for old, new in [(p, q) for p, q in zip((head, payload, signature), jwt.split("."), strict=True)] + [(long[:300], got[1][0][10:-5]), (long, got[2][0][7:])]:
        assert len(old) == len(new) and all(old[i : i + 8] != new[i : i + 8] for i in range(len(old) - 7))
    assert got[3][1] == 1 and got[3][0].startswith("password=short12. password=") and "long1234" not in got[3][0]


def test_dates_with_the_month_first(shared):
    got = pseudonymised(shared, ["2020-12-25 12-25-2020 12.25.2020 12/25/2020 25.12.2020", "13-25-2020 02-30-2020"])
    iso, dashed, dotted, slashed, day = got[0][0].split()
    y, m, d = iso.split("-")
    assert iso != "2020-12-25" and (dashed, dotted, slashed, day) == (f"{m}-{d}-{y}", f"{m}.{d}.{y}", f"{m}/{d}/{y}", f"{d}.{m}.{y}")
    assert got[0][1] == 5 and got[1] == ("13-25-2020 02-30-2020", 0)


def test_permutation_of_a_whole_format(shared):
    rows = shared.range(90).select((F.col("id") / 9).cast("long").alias("l"), F.pmod("id", F.lit(9)).alias("r"))
    got = rows.select(pseudonyms.permuted("k", "x", F.col("l"), F.col("r"), 10, 9).alias("p")).select("p.l", "p.r").collect()
    assert len(set(got)) == 90 and all(0 <= l < 10 and 0 <= r < 9 for l, r in got)  # noqa: E741
    words = shared.createDataFrame([(a + b + c,) for a in "019" for b in "az" for c in "AQ"], "w string")
    assert words.select(pseudonyms.permuted_text("k", "x", F.col("w"))).distinct().count() == 12


def plain_licenses(text):
    have = licenses.shingles_of(text or "")
    out = []
    for name, template in licenses.TEMPLATES.items():
        want = set(licenses.shingles_of(template))
        n = len(licenses.shingles_of(template))
        best = max((len(want & set(have[k * n : k * n + 2 * n])) / len(want) for k in range(len(have) // n + 1)), default=0)
        if best >= licenses.CONTAINED:
            out.append((name, best))
    return sorted(out)


def test_licenses_against_brute_force(shared):
    rng = random.Random(3)
    texts = [None, "", "license", "Released under the MIT License", "x y z license words"]
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        texts.append(" ".join(rng.choices("lorem ipsum dolor sit amet".split(), k=rng.randint(0, 90))) + "\n" + template.upper() + " end " * rng.randint(0, 40))
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
        texts.append(name + " " + template + " " + licenses.TEMPLATES["mit"])
    df = shared.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, license_words int")
    got = {r.doc_id: [(x.license, x.containment) for x in r.licenses] for r in licenses.find_licenses(df).collect()}
    assert got == {i: plain_licenses(t) for i, t in enumerate(texts)}


def test_bands_assure_retrieval():
    bands = licenses.bands_needed()
    alike = licenses.CONTAINED / (3 - licenses.CONTAINED)
    assert 1 - (1 - alike**licenses.ROWS) ** bands >= licenses.ASSURED


def test_mixing_against_sql(shared):
    folder = "/root/testdata/sf0.001"
    problem, rows, _ = compare(shared, connect(folder), folder, QUERIES["op8_mixing"], ORACLES["op8_mixing"])
    assert problem is None and rows > 0


def test_mixing_redistributes_to_siblings_first(shared):
    leaves = shared.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 500), ("b", "x", "3", 30), ("b", "y", "4", 5)], "domain string, lang string, source string, tokens long")
    weights = {"domain": {"*": 1}, "lang": {"*": 1}, "source": {"*": 1}}
    got = {r.source: r.budget for r in mixing.budgets(leaves, mixing.LEVELS, 200, weights, 1).collect()}
    # b cannot use its 100: a gets what is over, and there source 2 what source 1 leaves.
    assert got == {"1": 10, "2": 155, "3": 30, "4": 5}


def test_mixing_odd_rows(shared):
    rows = [(1, "a" * 40, None, None), (1, "a" * 40, None, None), (None, None, "en", "src3"), (2, "", "en", "src0"), (3, "b" * 400, "xx", "odd")]
    df = shared.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, source string, mix_size int")
    out = mixing.mix(df, share=1.0, epoch=None, domain=None, tokens=None)
    assert out.columns == df.columns and out.where("doc_id = 1").count() % 2 == 0
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def judged(shared):
    rng = random.Random(2)
    clean = "alpha bravo carbon delta echo forest garden harbor island jungle kettle ladder".split()
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) + rng.choice(["", "s", "ing", "ed"]) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zorkel", "quimble"])
            words[-1] = rng.choice(["zorkel", "quimble"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    marks = shared.createDataFrame(labels, "doc_id long, toxic int")
    return docs, marks, toxicity.fit(shared, docs, marks)


def test_toxicity_held_out_and_obfuscated(shared, judged):
    docs, marks, machine = judged
    scored = docs.join(marks, "doc_id").where(toxicity.held_out("doc_id")).select("toxic", toxicity.score(docs, machine).alias("p")).collect()
    assert len(scored) > 40 and sum((r.p >= 0.5) == (r.toxic == 1) for r in scored) >= 0.97 * len(scored)
    odd = shared.createDataFrame([(1, "alpha z-orkel echo"), (2, "garden q u i m b l e"), (3, None), (4, ""), (5, "alpha echo"), (6, "zor-kel! island")], "doc_id long, text string")
    p = {r.doc_id: r.p for r in odd.select("doc_id", toxicity.score(odd, machine).alias("p")).collect()}
    assert p[1] >= 0.5 and p[2] >= 0.5 and p[6] >= 0.5 and max(p[3], p[4], p[5]) < 0.5


def test_toxicity_without_labels(shared, judged):
    docs, marks, _ = judged
    machine = toxicity.fit(shared, docs, marks.limit(0))
    assert docs.select(toxicity.score(docs, machine).alias("p")).where("p >= 0.5").count() == 0
    assert toxicity.fit(shared, docs.limit(0), marks).bias < 0


def test_suffix_automaton_accepts_substrings_only():
    rng = random.Random(4)
    symbols = [rng.randint(0, 2) for _ in range(60)]
    move = language.suffix_automaton(symbols, 3)
    subs = {tuple(symbols[i:j]) for i in range(60) for j in range(i, 61)}
    for _ in range(2000):
        word = tuple(rng.randint(0, 2) for _ in range(rng.randint(1, 8)))
        state = 0
        for c in word:
            state = move[state, c] if state >= 0 else -1
        assert (state >= 0) == (word in subs)


def test_phrases_against_plain_parsing():
    samples = {"x": "der hund und die katze und das haus", "y": "the dog and the cat and the house"}
    model = language.build(samples)
    parser = language.Parser(model)

    def plain(text, sample):
        count = at = 0
        while at < len(text):
            n = 0
            while at + n < len(text) and text[at : at + n + 1] in sample:
                n += 1
            count += 1
            at += n + 1
        return count

    texts = ["the cat and a dog", "die katze", "zzz", "haushund der katze", "a" * 20]
    got = parser.phrases([parser.codes(t) for t in texts])
    assert got.tolist() == [[plain(t, samples[k]) for k in model.languages] for t in texts]


def test_language_query(shared):
    folder = "/root/testdata/sf0.001"
    docs = shared.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op10_language_id"](shared, folder).join(docs, "doc_id").collect()
    right = Counter(r.lang == r.lang_pred for r in got)
    assert right[True] >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    model = language.build({"x": "abc"})
    odd = shared.createDataFrame([(1, None), (2, ""), (3, "123 ½ !"), (4, "abc")], "doc_id long, text string")
    assert [r.j.lang_pred for r in odd.select("doc_id", language.identify(shared, model, F.col("text")).alias("j")).orderBy("doc_id").collect()] == ["und", "und", "und", "x"]
    assert language.fit(shared, docs.limit(0).withColumn("text", F.lit(""))).languages == []


def test_no_budget_is_kept_back_for_weight_zero(shared):
    leaves = shared.createDataFrame([("a", "x", "s", 500), ("b", "x", "s", 10), ("b", "y", "s", 400), ("c", "y", "s", 90)], "domain string, lang string, source string, tokens long")
    weights = {"domain": {"*": 1}, "lang": {"x": 1, "y": 0, "*": 1}, "source": {"*": 1}}
    got = {(r["domain"], r["lang"]): r["budget"] for r in mixing.budgets(leaves, mixing.LEVELS, 100, weights, 1).collect()}
    assert got == {("a", "x"): 90, ("b", "x"): 10, ("b", "y"): 0, ("c", "y"): 0}
