"""Language identification and toxicity, on made-up corpora and on held-out rows of the given tables."""

from __future__ import annotations

import zlib

import numpy as np
from cases import frame, prose

from linkharbor.llm import language, toxicity
from linkharbor.llm.queries import QUERIES

LETTERS = {"aa": "abcdefghi", "bb": "ijklmnopq", "cc": "qrstuvwxyé"}


def corpus(n: int = 90):
    rows = [(i, prose(i, 20 + i % 40, LETTERS[g := list(LETTERS)[i % 3]]), g) for i in range(n)]
    return [*rows, (500, None, "aa"), (501, "", "bb"), (502, "123 !!", "cc"), (503, prose(7, 30), None), (None, prose(8, 30, LETTERS["aa"]), "aa"), (4, rows[4][1], rows[4][2])]


def test_languages_are_learned_and_told(spark):
    df = frame(spark, corpus())
    model = language.learn(language.training_rows(df))
    assert model.languages == ("aa", "bb", "cc")
    fresh = [(900 + i, prose(4000 + i, 25, LETTERS[g]), g) for i, g in enumerate(list(LETTERS) * 8)]
    fresh += [(990, None), (991, ""), (992, "12 %"), (993, prose(4, 50_000, LETTERS["bb"]), "bb")]
    found = {r["doc_id"]: r for r in language.identify(frame(spark, fresh), model).collect()}
    assert all(found[r[0]]["lang_pred"] == r[2] for r in fresh if len(r) > 2)
    assert [(found[i]["lang_pred"], found[i]["score"]) for i in (990, 991, 992)] == [("und", 0.0)] * 3
    assert all(0 <= r["score"] <= 1 for r in found.values())
    # the prediction reads the text only
    moved = frame(spark, [(r[0] + 7, r[1], "zz") for r in fresh])
    assert {r["doc_id"] - 7: r["lang_pred"] for r in language.identify(moved, model).collect()} == {
        i: r["lang_pred"] for i, r in found.items()
    }


def test_weights_are_sparse_and_scores_calibrated(spark):
    model = language.learn(frame(spark, corpus()))
    assert (model.weights == 0).mean() > 0.5
    assert model.temperature > 0
    assert abs(language.softmax(np.array([1.0, 2.0, 3.0])).sum() - 1) < 1e-12


def test_nothing_to_learn_from(spark):
    df = frame(spark, [(1, None, "aa"), (2, "text", None), (3, "...", "aa")])
    model = language.learn(df)
    assert {r["lang_pred"] for r in language.identify(df, model).collect()} == {"und"}
    assert language.learn(df.limit(0)).languages == ()
    one = language.learn(frame(spark, [(1, "only one", "aa"), (2, "language here", "aa")]))
    assert one.predict("some text") == ("aa", 1.0)


def test_a_long_text_counts_the_same_in_parts(monkeypatch):
    text = prose(3, 4000, "abcdé") + " 日本 x"
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "PART", 997)
    parts = language.ngram_counts(text)
    near = np.abs(np.bincount(parts[0], parts[1], 1 << 16) - np.bincount(whole[0], whole[1], 1 << 16)).sum()
    assert near <= 12 * (len(text) / 997)  # the part borders count a few n-grams more


def test_parts_of_a_long_text_add_up_to_the_whole():
    for text in (prose(3, 4000, "abcdé") + " 日本 x", "  a  b\n\n", "", "x", "?!", "ab" * 30 + "   " * 20 + "𝔞b"):
        whole = language.ngram_counts(text, 1 << 30)
        for part in (1, 2, 3, 7, 997):
            if part < 900 and len(text) > 5000:
                continue
            found = language.ngram_counts(text, part)
            assert np.array_equal(found[0], whole[0]) and np.array_equal(found[1], whole[1])


def test_a_plain_follow_the_regularised_leader():
    """Ten features and two classes, row by row and weight by weight."""
    make = np.random.default_rng(4)
    idf = np.zeros(language.FEATURES)
    idf[:10] = make.uniform(0.5, 2, 10)
    rows = []
    for i in range(60):
        buckets = np.sort(make.choice(10, 4, replace=False))
        rows.append(("ab"[int(buckets[0] > 1)], False, buckets, make.integers(1, 5, 4)))
    model = language.fit(rows, idf)
    z, n, zb, nb = [[0.0, 0.0] for _ in range(10)], [[0.0, 0.0] for _ in range(10)], [0.0, 0.0], [0.0, 0.0]

    def weight(z, n, l1):
        size = abs(z) - l1
        return 0.0 if size <= 0 else -(size if z > 0 else -size) / ((language.BETA + n**0.5) / language.ALPHA + language.L2)

    order = np.random.default_rng(7)
    for _ in range(language.EPOCHS):
        for i in order.permutation(60):
            label, _, buckets, counts = rows[i]
            x = [float(np.log1p(c) * idf[b]) for b, c in zip(buckets, counts)]
            length = sum(v * v for v in x) ** 0.5
            x = [v / length for v in x]
            logit = [sum(v * weight(z[b][k], n[b][k], language.L1) for b, v in zip(buckets, x)) + weight(zb[k], nb[k], 0) for k in (0, 1)]
            top = [np.exp(v - max(logit)) for v in logit]
            for k in (0, 1):
                error = top[k] / sum(top) - (label == "ab"[k])
                for table_z, table_n, v, l1 in [(z[b], n[b], v, language.L1) for b, v in zip(buckets, x)] + [(zb, nb, 1.0, 0)]:
                    g = v * error
                    table_z[k] += g - ((table_n[k] + g * g) ** 0.5 - table_n[k] ** 0.5) / language.ALPHA * weight(table_z[k], table_n[k], l1)
                    table_n[k] += g * g
    want = [[weight(z[b][k], n[b][k], language.L1) for k in (0, 1)] for b in range(10)]
    assert np.allclose(model.weights[:10], want, atol=1e-6) and np.any(model.weights)
    assert np.allclose(model.bias, [weight(zb[k], nb[k], 0) for k in (0, 1)])


def test_the_sample_is_of_every_language(spark):
    df = frame(spark, [(i, f"text {i}", "aa" if i % 50 else "bb") for i in range(4000)] + [(None, "no id", "cc")])
    assert language.learn(df, per_language=100).languages == ("aa", "bb")  # a row is drawn by its id


def test_identified_rows_keep_their_columns(spark):
    df = frame(spark, corpus())
    kept = language.keep_identified(df, language.learn(df), 0.4)
    assert kept.columns == df.columns
    assert {500, 501, 502}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_held_out_language_of_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in QUERIES["op6_language_id"](spark, folder).collect() if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98


BAD = ["grumpwort", "zankhead", "blorfing"]


def toxic_corpus(n: int = 400):
    rows, labels = [], []
    for i in range(n):
        toxic = int(i % 5 == 0)
        words = prose(i, 40 + i % 30).split(" ")
        if toxic:
            words[5:5] = [BAD[i // 5 % 3]]
            words[20:20] = [BAD[i // 5 % 3].replace("o", "0")]
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    copied = "same copied text of many toxic rows with grumpwort in it"
    rows += [(1000 + i, copied) for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    return rows, [*labels, (None, 1), (5, None), (7, 0), (7, 0), (99_999, 1)]


def learned(spark):
    rows, labels = toxic_corpus()
    return toxicity.learn(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, text string".replace(", text string", "")))


def test_the_lexicon_is_what_marks_toxic_texts(spark):
    lexicon = learned(spark)
    assert set(lexicon.terms) == set(BAD)
    texts = [
        (1, f"a calm start {BAD[0]} and more"), (2, prose(9999, 60)), (3, ""), (4, None), (5, "GRUMPW0RT!"), (6, "grumрwоrt now"),
        (7, f"x{BAD[0]}"), (8, prose(8888, 20_000)), (9, f"{prose(3, 200)} {BAD[1]}."), (9, f"{prose(3, 200)} {BAD[1]}."), (None, BAD[2]),
    ]
    found = toxicity.score(frame(spark, texts), lexicon).collect()
    assert sorted((r["doc_id"] or 0) for r in found if r["predicted"]) == [0, 1, 5, 6, 9, 9]
    assert all(0 <= r["score"] <= 1 for r in found)


def test_every_run_of_signs_that_touches_a_letter_is_folded():
    told = {"$hit": "shit", "@ss": "ass", "a55hole": "asshole", "h00k": "hook", "id10t": "idiot", "loser5": "losers", "5h1t": "shit"}
    for text, plain in told.items():
        assert toxicity.fold(f"a {text.upper()}.") == f"a {plain}."
    kept = "in 2010, at 3:45 or 100 $ and $500 @ 7"
    assert toxicity.fold(kept) == kept
    lexicon = toxicity.Lexicon({"idiot": 5.0}, {}, 4.0, -6.0)
    assert lexicon.raw(toxicity.fold("you ID10T"), lexicon.automaton()) > 0


def test_other_disguises_are_folded():
    told = {
        "sh!t": "shit", "8itch": "bitch", "ıdiot": "idiot", "i\u0336d\u0336iot": "idiot", "𝓲𝓭𝓲𝓸𝓽": "idiot", "id\u200biot": "idiot", "i.d.i.o.t": "idiot",
        "ｉｄｉｏｔ": "idiot", "іdіоt": "idiot", "İDIOT": "idiot", "win10": "win10 winio", "covid19": "covid19", "u.s.a": "u.s.a", "wow!": "wow!",
    }
    for text, plain in told.items():
        assert toxicity.fold(f"a {text} b") == f"a {plain} b", text


def by_every_place(text, lexicon):
    """Weight per thousand words, each pattern tried at each place of the folded text."""
    folded, total = toxicity.fold(text), 0.0
    for pattern, weight in [*lexicon.terms.items(), *lexicon.exceptions.items()]:
        for at in range(len(folded)):
            if not folded.startswith(pattern, at) or (at and folded[at - 1].isalpha()):
                continue
            after = folded[at + len(pattern) : at + len(pattern) + 1]
            if after.isalpha() and (weight < 0 or len(pattern) < toxicity.SHORTEST):
                continue
            total += weight
    return np.log1p(1000 * max(total, 0.0) / (folded.count(" ") + 50))


def test_every_term_at_every_place():
    make = np.random.default_rng(8)
    lexicon = toxicity.Lexicon({"clow": 4.0, "clown": 1.5, "ass": 3.0, "idio": 5.0}, {"clown fish": -5.5, "ass mule": -3.0})
    machine = lexicon.automaton()
    pieces = ["clown", "clowns", "cl0wn", "ass", "assess", "bass", "@ss", "idiot", "i.d.i.o.t", "fish", "fishes", "mule", "x", "id10t", "Clown fish"]
    for _ in range(300):
        text = "".join(p + make.choice([" ", ", ", "", ".\n"]) for p in make.choice(pieces, make.integers(0, 12)))
        assert abs(lexicon.raw(toxicity.fold(text), machine) - by_every_place(text, lexicon)) < 1e-9, text


def test_accents_are_another_reading():
    lexicon = toxicity.Lexicon({"idio": 3.0, "été": 2.0}, {})
    one = lexicon.raw("idiot", lexicon.automaton())
    assert lexicon.raw(toxicity.fold("ÍDÏOT"), lexicon.automaton()) == lexicon.raw("idioté", lexicon.automaton()) == one
    assert lexicon.raw("ete", lexicon.automaton()) == 0 < lexicon.raw("été", lexicon.automaton())


def test_short_words_count_as_whole_words():
    assert toxicity._beginnings({"ass", "oxen", "a"}) == {"ass", "oxen"}
    lexicon = toxicity.Lexicon({"ass": 3.0}, {})
    assert lexicon.raw("an ass.", lexicon.automaton()) > 0 == lexicon.raw("assess a bass", lexicon.automaton())


def test_exceptions_take_the_weight_back():
    lexicon = toxicity.Lexicon({"clown": 5.0}, {"clown fish": -5.0}, 4.0, -6.0)
    machine = lexicon.automaton()
    assert lexicon.raw("a clown fish swims", machine) == 0
    assert lexicon.raw("a clown swims", machine) > 0
    assert lexicon.raw("a clown fishes", machine) > 0
    assert lexicon.raw("aclown", machine) == 0


def test_phrases_of_harmless_texts_are_exceptions(spark):
    rows, labels = toxic_corpus()
    rows += [(2000 + i, f"{prose(5000 + i, 30)} grumpwort soup {prose(6000 + i, 30)}") for i in range(3)]
    labels += [(2000 + i, 0) for i in range(3)]
    lexicon = toxicity.learn(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert lexicon.exceptions == {"grumpwort soup": -lexicon.terms["grumpwort"]}


def test_only_copies_of_one_label_leave_the_sample(spark):
    shared, text = prose(1, 40), prose(2, 90)
    rows = [(i, f"{shared} {prose(100 + i, 60)}", i % 2) for i in range(30)]  # a shared passage is no copy
    rows += [(100, text, 0), (101, f"{text} grumpwort", 1), (102, f"{text} and more", 0), (103, text.upper(), 1)]
    rows += [(200, "", 0), (201, "?!", 0), (202, "", 1), (300, prose(3, 50), 1), (300, prose(4, 50), 1)]
    train = spark.createDataFrame(rows, "id long, text string, toxic int").repartition(3)
    kept = sorted(r["id"] for r in toxicity._without_copies(train).collect())
    assert kept == [*range(30), 100, 101, 200, 202, 300, 300]


def test_no_labels(spark):
    rows, _ = toxic_corpus(20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = toxicity.learn(frame(spark, rows), none)
    assert {r["predicted"] for r in toxicity.score(frame(spark, rows), lexicon).collect()} == {0}
    assert toxicity.score(frame(spark, rows).limit(0), lexicon).count() == 0


def test_held_out_labels_of_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in QUERIES["op10_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    hits = sum(r["predicted"] and truth[r["doc_id"]] for r in held)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    assert hits / max(sum(r["predicted"] for r in held), 1) > 0.9
    assert hits / sum(truth[r["doc_id"]] for r in held) > 0.8
