"""Residue, main body, language and truncation on small pages with known answers."""

import random

import pytest
from pyspark.sql import functions as F

from fjordmill.llm import language, mainbody, residue, truncation

SCHEMA = "row_id long, url_hash string, original_url string, resolved_url string, content string, title string, language string, paywall_snippet string, error string, source string"
DA = ["Borgmesteren fra Aaby siger, at kommunen ikke har penge til den nye skole.", "Mange forældre spurgte, hvorfor planen blev ændret efter mødet.", "Derfor vil de følge sagen og skrive til rådet igen."]
EN = ["The mayor of the town says that there is no money for the new school.", "Many parents asked why the plan was changed after the meeting.", "That is why they will follow the case and write to the council again."]
DE = ["Der Bürgermeister der Stadt sagt, dass es kein Geld für die neue Schule gibt.", "Viele Eltern fragten, warum der Plan nach der Sitzung geändert wurde.", "Deshalb wollen sie die Sache verfolgen und wieder an den Rat schreiben."]


def pages(spark, rows):
    """rows: dicts; missing columns are null."""
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    full = []
    for k, r in enumerate(rows):
        r = {"row_id": k, "url_hash": f"h{k}", "original_url": f"https://avis{k}.example/{k}", "source": "s"} | r
        full.append(tuple(r.get(c) for c in cols))
    return spark.createDataFrame(full, SCHEMA).withColumn("site", F.lit("clash")).withColumn("bad_content", F.lit("clash")).withColumn("keys", F.lit(1)).withColumn("template", F.lit(1))


BAD = [
    "Hej {{ fornavn }}, tak", "Af ${author.name}", "x #{title} y", "x <%= city %> y", "x {% include a %} y", "x {amount} y", "Af {0}", "x %(price)s y", "x [[user_name]] y", "x <<city>> y", "x @@title@@ y", "x ##PLAN## y", "x %%NAME%% y",
    "x *|DATO|* y", "x __DATO__ y", "x $byline$ y", "x [INDSÆT FORNAVN HER] y", "x [INSERT AMOUNT] y", "Overskrift\nLorem ipsum dolor sit amet elit.", "Velit amet dolor nunc vitae elit.", "Overskrift her\nTekst kommer her", "Text kommer här", "Blindtext für die Vorschau",
    "Siden findes ikke længere", "Error 404\nReturn to the front page.", "Hov! – Du har ikke adgang til denne side – ID a5c0e767", "TypeError: cannot read field 'title' of undefined", '{"error":"not_found","status":404}', "<Error><Code>NoAccess</Code></Error>",
    "Slå JavaScript til i din browser for at bruge siden. Ray 5b1", "avis.example\nOne moment, we are checking that you are not a robot", "Bad gateway: the upstream did not answer", "Your browser is not supported. Update it to go on",
]
GOOD = [
    "Grafikeren skrev lorem ipsum på plakaten i Groby, og sagen overtog den bagefter.", "Fejl 404 var ugens vittighed i Bridal, efter at rådet ændrede hjemmesiden.", "Ministeren vil forbyde cookies, og rådet præsenterede derfor alle annoncer.", "Planen gav 38 % rabat [red.] til alle.",
    " ".join(DA) + "\nSlå JavaScript til i din browser for at bruge siden", "Klubben underviser i JavaScript hver tirsdag.", "3-0 | 71 % | 30,26\n3-4 | 1211", "", None, "   ", "x" * 50_000, "• Savholm\n• Savholm",
]


def test_residue(spark):
    rows = [{"content": t} for t in BAD + GOOD] + [{"content": "ok.", "paywall_snippet": "Artiklen er kun for <%= city %>.", "error": "http_%d"}, {"error": "timeout_after_30s"}, {"error": "failed: %s"}]
    df = pages(spark, rows)
    found = {tuple(r) for r in residue.residue_found(df).collect()}
    want = {(k, "content") for k in range(len(BAD))} | {(len(BAD + GOOD), "paywall_snippet"), (len(BAD + GOOD), "error"), (len(BAD + GOOD) + 2, "error")}
    texts = BAD + GOOD
    assert [texts[k] for k, f in found - want if k < len(texts)] == [] and [texts[k] for k, f in want - found if k < len(texts)] == [] and found == want
    clean = residue.without_residue(df)
    assert clean.columns == df.columns and clean.filter("content IS NULL").count() == len(BAD) + 3 and clean.filter("site = 'clash'").count() == len(rows)
    assert residue.residue_found(df.limit(0)).count() == 0


def test_host_evidence(spark):
    odd = "Something unheard of went astray here"
    rows = [{"content": odd + f" {k}"} for k in range(3)] + [{"content": "Only one host says this odd thing"}] * 5 + [{"content": odd + " 9", "title": "Something unheard of"}]
    rows = [r | {"original_url": "https://one.example/x"} if "Only" in r["content"] else r for r in rows]
    found = {r["row_id"] for r in residue.residue_found(pages(spark, rows)).collect()}
    assert found >= {0, 1, 2} and not found & {3, 4, 5, 6, 7}


PAGE = [
    ("Forside", 0), ("Nyheder  Log ind  Vejret", 0), ("Acceptér alle", 0), ("Avisen bruger cookies til statistik og annoncer. Vælg hvad du vil give lov til", 0), ("Rådet ændrede planen for den nye skole", 1), ("Af Palla Trasker", 1), (" ".join(DA), 1), ("Annonce", 0),
    ("", None), ("Baggrund", 1), ("Læs også: Rådet udsatte mødet om broen", 0), (DA[0] + " Foto: Vibo Dam", 1), ("• Nemlund", 1), ("72,79 | 66 %", 1), ("https://kort.example/cb83ed", 1), ("Aaby, 1.4.2014", 1), ("/ Sunna Ublund", 1), ("Del på Facebook", 0), ("Mest læste lige nu", 0),
    ("1. Prisen steg med 56 procent, og rådet ændrede planen", 0), ("20:18 Et flertal fornyede ordningen", 0), ("- Mange borgere spurgte til planen", 0), ("Rådet fornyede ordningen sidste uge", 0), ("« 1 2 3 4 »", 0), ("Tags: Eksten, Gromar", 0), ("Få Avisen i din indbakke hver morgen. Skriv din mailadresse her", 0),
    ("© 2025 Avisen – Alle rettigheder forbeholdes", 0), ("Privatlivspolitik · Cookiepolitik · Kontakt", 0), ("Avisen · Havnevej 11 · Aaby · Tlf. 00 14 18 00", 0),
]


def test_main_body(spark):
    text = "\n".join(x for x, _ in PAGE)
    rows = [{"content": text}, {"content": None}, {"content": ""}, {"content": "\n\n"}, {"content": "Siden findes ikke længere"}, {"content": "x " * 50_000}, {"content": text, "original_url": None}]
    df = pages(spark, rows)
    got = {tuple(r) for r in mainbody.furniture_lines(df).collect()}
    want = {k for k, (_, main) in enumerate(PAGE, 1) if main == 0}
    wrong = [PAGE[k - 1][0] for k in {k for r, k in got if r == 0} ^ want]
    assert wrong == [] and got == {(0, k) for k in want} | {(6, k) for k in want}
    bodies = {r["row_id"]: r["body"] for r in mainbody.main_bodies(df).collect()}
    assert bodies[0] == "\n".join(x for x, main in PAGE if main != 0) and 1 not in bodies and 4 not in bodies and bodies[2] == ""
    assert mainbody.furniture_lines(df.limit(0)).count() == 0


def test_template_by_host(spark):
    """A constant that no vocabulary knows is furniture where a host repeats it before its texts."""
    rows = [{"content": f"Velkommen til vores lille gode sted\n{DA[k % 3]} {DA[(k + 1) % 3]}", "original_url": f"https://lokal.example/{k}"} for k in range(5)]
    rows.append({"content": f"Velkommen til vores lille gode sted\n{DA[0]}", "original_url": "https://andet.example/1"})
    got = {tuple(r) for r in mainbody.furniture_lines(pages(spark, rows)).collect()}
    assert got == {(k, 1) for k in range(5)}


def test_language(spark):
    rows = [{"content": " ".join(p), "language": lab} for p, lab in [(DA, "da-DK"), (DA, "English"), (DA, None), (EN, "EN"), (EN, "x-default"), (DE, "Deutsch"), (DE, "sv_SE")] * 4]
    n = len(rows)
    right = [{"content": " ".join(p), "language": lab, "row_id": 1000 + k} for k, (p, lab) in enumerate([(DA, "da"), (EN, "en_US"), (DE, "de")] * 8)]
    rows += [{"content": " ".join(DA) + "\n" + " ".join(EN), "language": "dan"}, {"content": " ".join(DA) + "\n" + EN[0] + "\n" + " ".join(DA), "language": "da"}, {"content": "12 | 34", "language": None}, {"content": "", "language": None}, {"content": None}, {"content": "Siden findes ikke længere", "language": None}]
    # one host: the same short text from several hosts would be taken for a notice
    df = pages(spark, [r | {"original_url": "https://avis.example/1"} for r in rows + right])
    got = {}
    for r in language.mislabelled_segments(df).collect():
        got.setdefault(r["row_id"], {})[r["seg_no"]] = r["lang"]
    for k in range(0, n, 7):
        assert [got.get(k + j, {}).get(1) for j in range(7)] == [None, "da", "da", None, "en", None, "de"]
    assert got[n] == {1: "da", 2: "en"} and set(got) & {n + 1, n + 2, n + 3, n + 4, n + 5} == set()
    seg = language.language_segments(df).filter(f"row_id = {n}").collect()
    assert all(0.9 < r["confidence"] <= 1 for r in seg) and sum(r["n_sentences"] for r in seg) == 6
    assert language.language_segments(df.limit(0)).count() == 0
    doc = language.document_languages(df).filter(f"row_id = {n}").first()
    assert doc["lang"] == "da" and doc["languages"] == ["da", "en"] and doc["n_segments"] == 2


@pytest.mark.parametrize("label, want", [("da", "da"), ("DA", "da"), ("da_DK", "da"), ("Dansk", "da"), ("nb-NO", "no"), ("nor", "no"), ("Français", "fr"), ("und", None), ("", None), (None, None), ("x-default", None), ("-", None), ("swe", "sv")])
def test_labels(label, want):
    assert language.label_language(label) == want


def test_segments_are_best():
    """The path search against all splits, on small random scores."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(80):
        n = int(rng.integers(4, 8))
        scores = rng.normal(0, 5, (n, 3))
        best = None
        for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, n), r) for r in range(n)):
            edges = [0, *cuts, n]
            if any(b - a < 2 for a, b in zip(edges, edges[1:])):
                continue
            for langs in itertools.product(range(3), repeat=len(edges) - 1):
                if all(x != y for x, y in zip(langs, langs[1:])):
                    v = sum(scores[a:b, j].sum() for a, b, j in zip(edges, edges[1:], langs)) - 6 * (len(langs) - 1)
                    best = v if best is None else max(best, v)
        found = language.segments(scores, [0, 1, 2], 6.0)
        assert abs(sum(scores[a:b, j].sum() for a, b, j in found) - 6 * (len(found) - 1) - best) < 1e-9


def test_truncation(spark):
    whole = [" ".join(DA), DA[0] + "\nBaggrund", DA[0] + " Foto: Vibo Dam", DA[0] + "\nhttps://kort.example/x", DA[0] + "\n• Nemlund", DA[0] + " …", DA[0] + "...", DA[0] + "\n3-0 | 71 %", DA[0] + " ❤️", "Siden findes ikke længere", "Lorem ipsum dolor sit amet elit vel", "", None, "  "]
    cut = [DA[0] + " Mange forældre spu", DA[0] + " Mange forældre spurgte, hvorfor", "Mange for…", DA[0] + " Derfor vil […]", DA[0] + " Derfor vil de ...", DA[0] + " Derfor <a hre", DA[0] + " Derfor &quo", DA[0] + " Derfor </", DA[0] + " Derfor v�"]
    # the corpus: lines that others follow and finished sentences
    rows = [{"content": "\n".join([DA[0], "Baggrund", DA[1] + " Foto: Vibo Dam", "• Nemlund", DA[2]])} for _ in range(6)]
    n = len(rows)
    rows += [{"content": t} for t in whole + cut] + [{"content": "ok.", "paywall_snippet": "Køb adgang i 3 dage og læs videre om sagen. K"}, {"content": "ok.", "paywall_snippet": "Køb adgang i 3 dage og læs videre om sagen.... "}]
    df = pages(spark, rows)
    found = {(r["row_id"], r["field"]) for r in truncation.cut_fields(df).collect()}
    want = {(n + len(whole) + k, "content") for k in range(len(cut))} | {(n + len(whole + cut), "paywall_snippet")}
    texts = whole + cut
    assert [texts[k - n] for k, f in found ^ want if n <= k < n + len(texts)] == [] and found == want
    assert truncation.cut_fields(df.limit(0)).count() == 0
    rates = {(r["source"], r["field"]): r["rate"] for r in truncation.truncation_rates(df).collect()}
    assert 0 < rates["s", "content"] < 1


def test_spikes(spark):
    import random

    rng = random.Random(1)
    rows = [{"content": "æ" * 3 + "x" * rng.randrange(50, 400) + str(k)} for k in range(300)] + [{"content": f"{k:03d}" + "y" * 247} for k in range(30)]
    spikes = {(r["unit"], r["length"]) for r in truncation.length_spikes(truncation.text_fields(pages(spark, rows))).collect()}
    assert ("chars", 250) in spikes and ("bytes", 250) in spikes and len(spikes) == 2
    at = truncation.cut_at_limits(pages(spark, rows)).filter("at_limit").count()
    assert at >= 1


def test_spike_decides(spark):
    """At a limit only a known line is whole; elsewhere a line like one is, and so is a link."""
    known, like, link = "Nye tal om skolen", "Gode tal om skolen", "https://kort.example/sider/nr"
    rows = [{"content": f"{known}\n{DA[k % 3]} {k}."} for k in range(12)]
    n = len(rows)
    texts = [(f"{k:03d} " + DA[k % 3] * 9)[: 250 - len(end) - 2] + ".\n" + end for end in (known, like, link) for k in range(10)]
    free = [f"{DA[0]}\n{like}", f"{DA[1] * 2}\n{link}"]
    df = pages(spark, rows + [{"content": t} for t in texts + free])
    assert {len(t) for t in texts} == {250}
    found = {r["row_id"] for r in truncation.cut_at_limits(df).filter("at_limit").collect()}
    assert found == set(range(n + 10, n + 30)) == {r["row_id"] for r in truncation.cut_fields(df).collect()}
    assert truncation.truncation_rates(df).first()["n_cut"] == 20


@pytest.mark.parametrize("size", [1, 10])
def test_units_are_relative(spark, size):
    """Words that seldom end a unit don't make one whole, however large the corpus; a page cached again counts once."""
    noun = ["skolen", "broen", "vejen", "havnen", "byen"]
    rows = [{"content": f"{DA[0]}\nVi fik planen om {noun[k % 5]} og parken {k}."} for k in range(60 * size)] + [{"content": f"{DA[0]}\nVi fik planen om\nSlut nr {k}."} for k in range(2 * size)]
    n = len(rows)
    rows += [{"content": f"{DA[0]} {k}.\nDe kom til byen\nSlut."} for k in range(40 * size)]
    rows += [{"content": f"{DA[2]}\nHan skrev en bog\nSlut."}] * 3
    m = n + 40 * size + 3
    rows += [{"content": f"{DA[1]}\n{x}"} for x in ("Nu fik planen om", "Hun skrev en bog", "Vi kom til byen", "Han skrev en bog")]
    found = {r["row_id"] for r in truncation.cut_fields(pages(spark, rows)).collect()}
    assert found == {m, m + 1}


def test_pseudo_latin_anywhere(spark):
    run = "lorem ipsum amet elit nunc"
    bad = [f"Overskrift {a}{x} og mere." for a in ("– ", "»", "(", "her, ", "<p>", "om ", "om\t") for x in (run, run.capitalize(), run.upper())] + ["Title – Lorem ipsum dolor sit amet", "VELIT AMET DOLOR NUNC VITAE"]
    good = ["Overskrift om lorem ipsum amet elit her.", "Xlorem ipsum amet elit nuncx.", "ålorem ipsum amet elit nunc"]
    df = pages(spark, [{"content": x} for x in bad + good] + [{"content": "ok.", "paywall_snippet": bad[0]}])
    found = {tuple(r) for r in residue.residue_found(df).collect()}
    assert found == {(k, "content") for k in range(len(bad))} | {(len(bad + good), "paywall_snippet")}


def test_furniture_sentences(spark):
    """A sentence on many pages of a host is furniture; so are long sentences in furniture wordings."""
    notice = "Vi passer på dine oplysninger og beder dig tage stilling til dem, før du går videre til siderne her hos os."
    prompt = "Få Avisen i din indbakke hver morgen, så du altid ved, hvad der sker i byen og i landet."
    rights = "© 2025 Avisen, som alle har lov til at læse, men ingen må gengive uden at spørge redaktionen først om det."
    rows = [{"content": f"{notice}\nSag {chr(97 + k)} {DA[k % 3]}\nKort sagt om dem.\n{prompt}\n{rights}", "original_url": f"https://lokal.example/{k}"} for k in range(6)]
    rows += [{"content": f"{notice}\n{DA[0]}\n{prompt}\n{rights}", "original_url": "https://andet.example/1"}]
    got = {tuple(r) for r in mainbody.furniture_lines(pages(spark, rows)).collect()}
    assert got == {(k, x) for k in range(6) for x in (1, 3, 4, 5)} | {(6, 3), (6, 4)}


def test_long_failure_messages(spark):
    long = "x" * 40 + " y" * 200
    bad = ['{"error": "' + long + '"}', "Traceback (most recent call last): " + long, "Fatal error: " + long, "<Error><Code>NoAccess</Code>" + long, "TypeError: " + long]
    good = [long + " access denied", "Avisen skriver: fatal error: " + long, "Warning: " + long]
    df = pages(spark, [{"content": x} for x in bad + good] + [{"content": "ok.", "paywall_snippet": bad[0]}])
    found = {tuple(r) for r in residue.residue_found(df).collect()}
    assert found == {(k, "content") for k in range(len(bad))} | {(len(bad + good), "paywall_snippet")}
    assert all(truncation.is_notice_text(x, None) for x in bad) and not any(truncation.is_notice_text(x, None) for x in good)


def _host(n, name="stor.example", marks=("Reklame her", "Nyt i dag", "Sagen kort")):
    """n pages of one host in a template that no vocabulary knows, with the lines that aren't main body."""
    mark, opener, heading = marks
    noun = lambda k: "".join(random.Random(k).choices("aefgiklmnorstuv", k=8)) + "en"
    rows, want = [], set()
    for k in range(n):
        a, b = noun(k), noun(k + 1000)
        lines = [("Krogen", 0), ("Stuen", 0), ("Gangen", 0), (f"Sag {k} om {a} og {b} begynder nu", 1), (f"Rådet talte om {a} i går, og {b} blev nævnt {k} gange.", 1)]
        lines += [(heading, 1)] if k % 2 else []
        lines += [(f"Mange havde set {b} før, men {a} var ny for {k} af dem.", 1)]
        lines += [(mark, 0)] if k % 3 else []
        lines += [(f"Derfor vil de gå til {a} igen om {k} dage.", 1), (mark, 0) if k % 4 == 0 else ("", None)]
        lines += [(opener, 0), (f"Nu er {a} nummer {k} lukket", 0), (f"Folk spurgte til {b} nummer {k}", 0), ("Krogen  Stuen", 0), ("Vi bor i huset med det røde tag", 0)]
        rows.append({"content": "\n".join(x for x, _ in lines), "original_url": f"https://{name}/{k}"})
        want |= {(k, no) for no, (_, main) in enumerate(lines, 1) if main == 0}
    return rows, want


def test_wrapper_decides(spark, monkeypatch):
    """Templates carry the result on hosts with enough pages; without them other lines come out."""
    rows, want = _host(60)
    got = {tuple(r) for r in mainbody.furniture_lines(pages(spark, rows)).collect()}
    assert got == want
    monkeypatch.setattr(mainbody, "CONSTANT_PAGES", 1_000)
    monkeypatch.setattr(mainbody, "SHARED_HOSTS", 1_000)
    without = {tuple(r) for r in mainbody.furniture_lines(pages(spark, rows)).collect()}
    assert len(without & want) < 0.7 * len(want)


def test_shared_template(spark):
    """A host of one page has the constants that other hosts share."""
    rows = [r for h in range(4) for r in _host(12, f"avis{h}.example")[0]]
    rows.append({"content": "Stuen\nEn ny sag om noget andet begynder\nRådet mødtes på torvet i går.\nReklame her\nDe gik hjem igen bagefter.", "original_url": "https://lille.example/1"})
    got = {tuple(r) for r in mainbody.furniture_lines(pages(spark, rows)).filter(f"row_id = {len(rows) - 1}").collect()}
    assert got == {(len(rows) - 1, 1), (len(rows) - 1, 4)}


def test_align():
    """The bounds of the main slot against all bounds."""
    rng = random.Random(3)
    for _ in range(200):
        w = [tuple(rng.choice((-4.0, -1.0, 0.0)) for _ in range(3)) for _ in range(rng.randrange(0, 7))]
        value = lambda s, e: sum(x[0] for x in w[:s]) + sum(x[1] for x in w[s:e]) + sum(x[2] for x in w[e:])
        start, end = mainbody.align(w)
        assert start <= end and abs(value(start, end) - max(value(s, e) for s in range(len(w) + 1) for e in range(s, len(w) + 1))) < 1e-9


def _answers(n_hosts=40):
    """Notices in wordings that no list knows, composed of fragments, and short articles with shared menus."""
    parts = ["Doren kan ikke lukkes op nu", "Kom igen når huset er vågent", "Nøglen passer ikke her mere", "Vagten tæller alle der går ind"]
    rng, rows, bad = random.Random(4), [], set()
    for k in range(n_hosts * 3):
        site = f"avis{k % n_hosts}"
        word = lambda: "".join(rng.choices("aefgiklmnorstuv", k=9))  # noqa: E731, B023
        if k % 2:
            bad.add(k)
            text = rng.choice((" – ", "\n", ". ")).join([site.capitalize()] * (k % 4 == 1) + rng.sample(parts, rng.randrange(1, 4)) + [f"Ref: {rng.randrange(10**9):x}1"] * (k % 3 == 0))
        else:
            text = f"Krogen og stuen her\nGangen er til venstre\n{word()} {word()} om {word()}\n{word()} kom til {word()} i går."
        rows.append({"content": text, "title": f"Sagen om {word()} og {word()}", "original_url": f"https://{site}.example/{word()}/{k}"})
    return rows, bad


def test_evidence_decides(spark, monkeypatch):
    rows, bad = _answers()
    df = pages(spark, rows)
    got = {r["row_id"] for r in residue.residue_found(df).collect()}
    assert not got - bad and len(got) >= 0.9 * len(bad)
    monkeypatch.setattr(residue, "EVIDENCE_HOSTS", 10_000)
    assert residue.host_evidence(df.withColumn("site", residue.host("original_url")), hosts=10_000).count() == 0


def test_half_the_wordings(spark, monkeypatch):
    """Evidence of several hosts stands in for wordings that are missing."""
    known = ["Siden findes ikke længere", "Du har ikke adgang til denne side", "Der opstod en fejl på serveren", "Slå JavaScript til i din browser for at bruge siden", "Vi skal lige sikre os, at du ikke er en robot", "Bad gateway: the upstream did not answer"]
    rows = [{"content": "\n".join([known[k % 6], known[(k + 1 + k // 6) % 6]]), "title": f"Sagen {k}", "original_url": f"https://avis{k}.example/sag-{k}"} for k in range(36)]
    half = random.Random(1).sample(residue.NOTICES, len(residue.NOTICES) // 2)
    monkeypatch.setattr(residue, "NOTICE", "(?U)" + residue.joined(half))
    found = {r["row_id"] for r in residue.residue_found(pages(spark, rows)).collect()}
    assert len(found) >= 0.9 * len(rows)


def test_mixture_decides():
    """The set of languages depends on the proportions that expectation-maximisation finds, not on each sentence's best language."""
    import numpy as np

    rng = np.random.default_rng(1)
    # two languages that are almost alike over many sentences: as a mixture one of them explains all
    near = np.column_stack([np.zeros(40), rng.choice([-0.4, 0.4], 40), np.full(40, -9.0)])
    assert np.maximum(near[:, 0], near[:, 1]).sum() - near[:, 0].sum() > language.SET_PENALTY
    mix = language.proportions(near, np.zeros(40, dtype=int), 1)[0]
    assert len(language.language_set(near, mix)[0]) == 1
    # two languages that differ: both stay, in their proportions
    far = np.array([[0.0, -8.0, -9.0]] * 9 + [[-8.0, 0.0, -9.0]] * 3)
    chosen, shares = language.language_set(far, language.proportions(far, np.zeros(12, dtype=int), 1)[0])
    assert sorted(chosen) == [0, 1] and abs(dict(zip(chosen, shares))[0] - 0.75) < 0.01
    # the log-likelihood grows with each round and is that of its definition
    last = -np.inf
    for rounds in range(6):
        w, like = language.mixture(far, [0, 1, 2], rounds)
        assert like >= last - 1e-9 and abs(like - np.log(np.exp(far) @ w).sum()) < 1e-9
        last = like
    # proportions decide between languages that a short text can't tell apart
    tie = np.array([[0.0, 0.2, -9.0], [0.0, 0.2, -9.0]])
    assert language.segments(tie, [0, 1])[0][2] == 1 and language.segments(tie, [0, 1], shares=np.array([0.9, 0.1]))[0][2] == 0


def test_sample_is_bounded(spark):
    rows = [{"content": " ".join(DA) if k % 2 else " ".join(EN), "language": "da" if k % 2 else "en"} for k in range(60)] + [{"content": "x " * 9000, "language": "da"}]
    df = pages(spark, rows)
    got = []
    real, language.fit = language.fit, lambda sample: got.append(sample)
    try:
        language.fit_on(df, rows=20, chars=5000)
    finally:
        language.fit = real
    assert len(got[0]) == 20 and max(len(t) for _, t in got[0]) <= 5000
