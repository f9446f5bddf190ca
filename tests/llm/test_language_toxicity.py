"""Language identification and toxicity: held-out accuracy, evidence and defined cases."""

import itertools
import zlib

import numpy as np
import pytest

from marquee.llm import deobfuscate, language_id, toxicity
from marquee.llm.queries import op1_language_id
from textcases import prose, table


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(docs):
    return language_id.learn_text_model(language_id.labelled_documents(docs), language_id.LanguagePolicy())


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_documents(spark, small, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = op1_language_id(spark, small).collect()
    own = [r for r in got if r.doc_id is not None]
    assert sorted(r.doc_id for r in own) == sorted(lang)
    tried = [r for r in own if held_out(r.doc_id)]
    assert np.mean([r.lang == lang[r.doc_id] and r.kept for r in tried]) > 0.95
    pages = [r for r in got if r.page_id is not None]
    assert len(pages) == spark.read.parquet(f"{small}/pages.parquet").count()


def test_languages_defined_cases(spark, edge, edge_rows, none, model):
    got = language_id.identify(edge, None, model).collect()
    assert len(got) == len(edge_rows)
    assert all(r.lang == "und" and not r.kept for r in got if r.doc_id in (1, 2, 3, 14))
    assert all(0 <= r.probability <= 1 for r in got)
    assert language_id.identify(none, None, model).collect() == []


def test_text_in_no_language_is_rejected(spark, model):
    rows = [(1, "qxz kjwv zzxq pfqk vbnm xqjz wkvq zxcv qwrt", None, None), (2, "你好世界这是中文文本", None, None), (3, "1 2 3", None, None)]
    assert not any(r.kept for r in language_id.identify(table(spark, rows), None, model).collect())


def test_without_labels_all_is_unknown(spark, docs):
    nothing = language_id.learn_text_model(language_id.labelled_documents(docs.limit(0)), language_id.LanguagePolicy())
    assert {r.lang for r in language_id.identify(docs, None, nothing).collect()} == {"und"}


def test_every_labelled_language_is_learned(spark):
    """More languages than a task holds tables of."""
    def say(lang, seed):
        words = prose(9000 + lang, 40).split()
        return " ".join(words[(seed * 7 + i * i) % 40] for i in range(60))

    rows = [(lang * 10 + i, say(lang, i), f"l{lang:03}", "a") for lang in range(90) for i in range(4 - lang % 3)]
    docs = table(spark, rows).coalesce(1)
    model = language_id.learn_text_model(docs.select("text", "lang"), language_id.LanguagePolicy())
    assert model.languages == [f"l{lang:03}" for lang in range(90)]
    got = {r.doc_id: r for r in language_id.identify(docs, None, model).collect()}
    assert all(got[i].lang == lang and got[i].kept for i, _, lang, _ in rows)


def test_sample_is_spread_over_languages(spark):
    rows = [(prose(i, 30), "aa") for i in range(1_000)] + [(prose(5_000, 30), "bb"), (prose(5_001, 30), "bb")]
    rows += [(prose(6_000, 30), "cc")] * 300
    labelled = spark.createDataFrame(rows, "text string, lang string")
    languages, sample = language_id.sample_languages(labelled, language_id.LanguagePolicy(sample_rows=42))
    counts = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert languages == ["aa", "bb", "cc"] and counts["bb"] == 2 and counts["cc"] == 300 and 5 < counts["aa"] < 60
    assert language_id.spread({"aa": 1_000, "bb": 2, "cc": 300}, 42) == {"aa": 20, "bb": 2, "cc": 20}


def test_declaration_and_host_speak_where_the_text_is_short(spark, docs, model):
    """Pages of one host are German by text and by declaration; two more of them say next to nothing."""
    german = [r.text[:400] for r in docs.where("lang = 'de'").limit(20).collect()]
    page = "<html lang='{}'><body><p>{}</p></body></html>"
    rows = [(i, f"http://w.seite.de/{i}", page.format("de", text)) for i, text in enumerate(german)]
    rows += [(90, "http://w.seite.de/x", page.format("de", "ber")), (91, "http://w.seite.de/y", page.format("", "")),
             (92, None, None), (93, "no address", "<p>ber")]
    got = {r.page_id: r for r in language_id.identify(None, spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert got[90].lang == "de" and got[90].probability > got[93].probability
    assert got[91].lang == "und" and not got[92].kept


def test_page_parts(spark):
    rows = [(1, "https://u:p@Blog.Example.co.UK:80/a?b", "<!DOCTYPE html><HTML class='x' lang=\"PT-br\"><script>var t='x</p>';</script><p>Olá</p>")]
    row = language_id.of_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).first()
    assert (row.host, row.suffix, row.domain, row.declared, row.text.strip()) == ("blog.example.co.uk", "uk", "co.uk", "PT", "Olá")


@pytest.fixture(scope="module")
def letters(docs):
    return toxicity.language_model(docs)


@pytest.mark.parametrize("written", [
    "1d10t", "idioooot", "i.d.i.o.t", "1di0t", "id1ot", "i-d-i-o-t", "1d!ot", "iiidiot",
])
def test_restores_disguises(letters, written):
    core = deobfuscate.bare(written)
    assert deobfuscate.is_disguised(core) and deobfuscate.restore(core, letters) == "idiot"


def test_leaves_plain_words(letters):
    assert not any(map(deobfuscate.is_disguised, ["the", "hello", "2024", "x", "", "a-1-b%", "letter"]))
    assert deobfuscate.bare("what?!") == "what" and deobfuscate.bare("$tupid,") == "$tupid"
    assert deobfuscate.spaced_words("so i d i o t and a b".split()) == ["idiot"]


def test_restore_finds_the_best_path(letters):
    """Viterbi against every path through a small lattice."""
    for token in ("1d1ot", "s33n", "th3ee", "a.4b", "00ps"):
        best = max(paths(deobfuscate._runs(token), letters), key=lambda p: p[0])
        assert deobfuscate.restore(token, letters) == best[1]


def paths(runs, model, at=(0, 0), score=0.0, text=""):
    if not runs:
        yield score + model[at[0], at[1], 0], text
        return
    for letters, cost in deobfuscate._arcs(*runs[0]):
        here, total = at, score + cost
        for byte in letters.encode():
            code = deobfuscate.byte_codes()[byte]
            total += model[here[0], here[1], code]
            here = here[1], code
        yield from paths(runs[1:], model, here, total, text + letters)


@pytest.fixture(scope="module")
def plain_letters():
    text = "you are a moron and an idiot . that is shit . what an ass , i said to a man . " * 50
    return deobfuscate.log_probabilities(deobfuscate.trigram_counts(text))


@pytest.mark.parametrize("written, words", [
    ("so i d i o t. and", {"idiot"}), ("a m o r o n", {"moron"}), ("i d i o t m o r o n", {"idiot", "moron"}),
    ('"y o u i d i o t!"', {"you", "idiot"}), ("1 d i 0 t", {"idiot"}), ("m o o o o r o n", {"moron"}),
    ("a$$", {"ass"}), ("a$$!", {"ass"}), ("a$$?!", {"ass"}), ("idio+", {"idiot"}), ("shi+,", {"shit"}),
    ("(moron)", {"moron"}), ("!diot", {"idiot"}), ("1diot" + "t" * 60, {"idiot"}), ("i" + "." * 50 + "diot", {"idiot"}),
])
def test_spaces_and_signs_at_the_ends(plain_letters, written, words):
    listed = written.split()
    found = [w for _, own in toxicity.restored_words(set(listed), listed, plain_letters) for w in own]
    assert words <= set(found)


def test_long_runs_are_decoded_in_linear_time(plain_letters):
    assert deobfuscate.restore_spaced("x" * 20_000, plain_letters)
    assert deobfuscate.readings("a" + "+!" * 5_000, plain_letters) and deobfuscate.readings("a1" * 20_000, plain_letters)


def test_restore_spaced_finds_the_best_words(plain_letters):
    """Against every way to end words between the signs, each word at its own best."""
    for run in ("amoron", "asss", "ss1t", "iiid"):
        scores = {}
        for cuts in itertools.product((False, True), repeat=len(run) - 1):
            parts = "".join(ch + " " * cut for ch, cut in zip(run, (*cuts, False), strict=True)).split()
            for chosen in itertools.product(*(all_readings(deobfuscate._runs(part)) for part in parts)):
                at, total = (0, 0), sum(cost for _, cost in chosen)
                for code in [c for word, _ in chosen for c in (*(deobfuscate.byte_codes()[b] for b in word.encode()), 0)]:
                    total += plain_letters[at[0], at[1], code]
                    at = at[1], code
                scores[tuple(word for word, _ in chosen)] = max(total, scores.get(tuple(w for w, _ in chosen), -np.inf))
        assert tuple(deobfuscate.restore_spaced(run, plain_letters)) == max(scores, key=scores.get)


def all_readings(runs):
    return [
        ("".join(letters for letters, _ in arcs), sum(cost for _, cost in arcs))
        for arcs in itertools.product(*(deobfuscate._arcs(*run) for run in runs))
    ]


@pytest.fixture(scope="module")
def toxic_case(spark):
    """Toxic documents hold one of two words, sometimes disguised; a third of them and others are held out."""
    insults = ["snarfle", "wugbat"]
    rows, labels = [], []
    for i in range(400):
        words = prose(1000 + i, 30).split()
        bad = i % 4 == 0
        if bad:
            words[i % 29] = insults[i // 4 % 2] if i % 8 else "snarf1e" if i // 8 % 2 else "w.u.g.b.a.t"
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(bad)))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(toxic_case):
    docs, labels = toxic_case
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert sorted(got) == list(range(400))
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    tried = [(i % 4 == 0, r.predicted == 1) for i, r in got.items() if r.held_out]
    assert np.mean([a == b for a, b in tried]) > 0.95


def test_toxicity_learns_from_no_held_out_label(toxic_case):
    from pyspark.sql import functions as F

    docs, labels = toxic_case
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [
        {r.doc_id: round(r.score, 9) for r in toxicity.score_toxicity(docs, own).collect()} for own in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_toxicity_defined_cases(edge, edge_rows, none, toxic_case):
    labels = toxic_case[1]
    got = toxicity.score_toxicity(edge, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(none, labels).collect() == []
    alone = toxicity.score_toxicity(edge, labels.limit(0)).collect()
    assert len(alone) == len(edge_rows) and {r.score for r in alone} == {0.0}


def test_curve_fits():
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    y = rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))
    slope, offset = toxicity.fit_curve(x, y.astype(float))
    assert abs(slope - 2) < 0.2 and abs(offset + 1) < 0.2


@pytest.mark.parametrize("written", [
    "1d10t", "id.iot", "i_d_i_o_t", "i d i o t", "i  d  i  o  t", "id iot", "i d iot", "iiddiioott", "(i)(d)(i)(o)(t)",
    "id*ot", "id#ot", "i​d​i​o​t", "ｉｄｉｏｔ", "ïdíôt", "id­iot", "1D10T!", "so, id iot.",
])
def test_words_are_restored_from_whole_lines(letters, written):
    listed, known = deobfuscate.tokens_of(written), {"idiot"}
    beginnings = {"idiot"[:n] for n in range(1, 5)}
    words = {word for _, own in toxicity.restored_words(set(listed), listed, letters) for word in own}
    assert "idiot" in words | set(deobfuscate.joined_pieces(listed, known, beginnings, letters))


def test_parts_of_a_token_are_read_each(letters):
    assert {"idiot", "moron"} <= set(deobfuscate.readings("1d1ot,m0r0n", letters))
    assert deobfuscate.spaced_words("a s s".split()) == ["ass"]


def test_pieces_are_joined_where_one_word_is_likelier(letters):
    known = {"idiot", "theand"}
    beginnings = {word[:n] for word in known for n in range(1, len(word))}
    assert deobfuscate.joined_pieces("an id iot, the and of id".split(), known, beginnings, letters) == ["idiot"]
    words = ["the", "id", "iot"]
    plain = sum(np.sum([letters[k] for k in zip(c, c[1:], c[2:], strict=False)]) for c in (
        [0, 0, *(ord(ch) - 96 for ch in word), 0] for word in words
    ))
    assert abs(deobfuscate.log_likelihood(words, letters) - plain) < 1e-9


def test_weights_are_the_plain_ones(spark, docs, letters, small):
    """Counts, log odds and errors in plain Python; and a text's evidence from them."""
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = [(r.text or "", int(labels.get(r.doc_id) or 0)) for r in docs.collect()]
    rows = list({text: (text, toxic) for text, toxic in rows}.values())
    policy = toxicity.ToxicPolicy(least_documents=2, least_odds=0.2, strongest=3)
    sent = spark.sparkContext.broadcast(letters)
    got = toxicity.learn_weights(spark.createDataFrame(rows, "text string, toxic int").repartition(3), sent, policy)
    bad, good, counts = sum(t for _, t in rows), sum(1 - t for _, t in rows), {}
    for text, toxic in rows:
        listed = deobfuscate.tokens_of(text)
        words = {w for _, own in toxicity.restored_words(set(listed), listed, letters) for w in own}
        for feature in set(toxicity.features(sorted(words), policy)):
            x, n = counts.get(feature, (0, 0))
            counts[feature] = x + toxic, n + 1
    wanted = {}
    for feature, (x, n) in counts.items():
        odds = np.log((x + 0.5) / (bad + 1)) - np.log((n - x + 0.5) / (good + 1))
        error = np.sqrt(1 / (x + 0.5) + 1 / (n - x + 0.5))
        if x >= 2 and odds - 2 * error >= 0.2:
            wanted[feature] = odds - error
    assert wanted and got == pytest.approx(wanted)

    evidence = toxicity._evidence_udf(sent, spark.sparkContext.broadcast(got), policy)
    texts = [text for text, _ in rows[:40]]
    found = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).select(evidence("text").alias("e")).collect()
    whole = {f for f in got if not f.endswith("-") and len(f) > 2}
    for text, row in zip(texts, found, strict=True):
        listed = deobfuscate.tokens_of(text)
        best = {}
        groups = [own for _, own in toxicity.restored_words(set(listed), listed, letters)]
        groups += [[w] for w in deobfuscate.joined_pieces(listed, whole, {w[:n] for w in whole for n in range(1, len(w))}, letters)]
        singles = [[w] for t, own in toxicity.restored_words(set(listed), listed, letters) if t not in set(listed) for w in own]
        for words in [*groups, *singles]:
            own = [(got[f], w) for w in words for f in toxicity.features([w], policy) if f in got]
            if own:
                weight, word = max(own)
                best[word] = weight
        assert row.e == pytest.approx(sum(sorted(best.values(), reverse=True)[:3]))


def plain_fusion(rows, model, policy):
    """Posteriors of (text, declared, suffix, domain, host) one after another, with sums over all the others."""
    names = [*model.languages, language_id.UNKNOWN]
    width = len(names)
    logs = [None if (x := model.log_likelihoods(r[0] or "")) is None else np.array(x) * policy.tempering for r in rows]
    start = np.log([(1 - policy.unknown_prior) / (width - 1)] * (width - 1) + [policy.unknown_prior])

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    first = [None if x is None else softmax(x + start) for x in logs]
    whole = sum((p for p in first if p is not None), np.zeros(width)) + 1e-6
    overall, found = whole / whole.sum(), []
    for at, row in enumerate(rows):
        if logs[at] is None:
            found.append((language_id.UNKNOWN, 0.0))
            continue

        def others(column, row=row, at=at):
            value = row[column]
            if value is None:
                return None
            same = [p for i, p in enumerate(first) if i != at and p is not None and (rows[i][column] or "").lower() == value.lower()]
            return sum(same, np.zeros(width))

        prior = overall
        for column in (3, 4):
            sums = others(column)
            if sums is not None:
                prior = (sums + policy.host_weight * prior) / (sums.sum() + policy.host_weight)
        total = logs[at] + np.log(prior)
        for column in (1, 2):
            sums = others(column)
            if sums is not None and sums.sum() > 1e-9:
                little = policy.link_weight * sums.sum() / whole.sum()
                total = total + np.log((sums + little) / (whole + policy.link_weight))
        fused = softmax(total)
        found.append((names[int(fused.argmax())], float(fused.max())))
    return found


def test_fusion_is_the_plain_one(spark, docs, model):
    """Every declaration, suffix, domain and host counts the other rows alone; rows without text count for nothing."""
    rng = np.random.default_rng(4)
    texts = [r.text for r in docs.limit(40).collect()]
    pick = lambda *of: str(rng.choice(of))
    rows = []
    for i in range(60):
        text = (texts[i % 40] or "")[: int(rng.integers(0, 90))]
        domain = pick("a.de", "b.fr", "c.com") if i % 4 else None
        rows.append((text if i % 9 else None, pick("de", "FR", "en") if i % 3 else None, pick("de", "fr") if i % 5 else None,
                     domain, f"w{i % 3}.{domain}" if domain else None))
    rows += [("the one text with this declaration", "xx", None, None, None)] + rows[:4]
    columns = "text string, declared string, suffix string, domain string, host string, at int"
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], columns).repartition(3)
    got = {r.at: (r.lang, r.probability) for r in language_id.fuse(frame, model).collect()}
    for at, (lang, probability) in enumerate(plain_fusion(rows, model, language_id.LanguagePolicy())):
        assert got[at][1] == pytest.approx(probability, abs=1e-9)
        assert got[at][0] == lang or probability == 0.0


def test_pages_are_mostly_in_their_declared_language(spark, small):
    """The declaration is evidence, not the answer; still most pages that declare one of the known languages are in it."""
    pages = spark.read.parquet(f"{small}/pages.parquet")
    declared = {r.page_id: r.declared for r in language_id.of_pages(pages).select("page_id", "declared").collect()}
    known = {r.page_id: r.lang for r in op1_language_id(spark, small).collect() if r.page_id is not None}
    judged = [(known[i], lang.lower()) for i, lang in declared.items() if lang and lang.lower() in {"en", "de", "fr", "es"}]
    assert len(known) == len(declared)
    assert not judged or np.mean([a == b for a, b in judged]) > 0.8
