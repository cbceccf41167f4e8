import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quaymark.llm import sentences as module
from quaymark.llm.sentences import sentence_spans, sentences, word_lattice


def cut(text):
    return [text[a:b] for a, b in sentence_spans(text)]


CASES = {
    "abbreviations": ["Mr. Ulm met Dr. J. K. Ost at No. 5, cf. p. 2.", "Sales, incl. freight, rose 3.5 percent vs. a forecast of 2.1.", "The order came from the U.S.", "In May, it fell."],
    "country": ["The U.S. Treasury sold bills.", "Trading resumed at 7 a.m. Eastern time.", "It closed at 4 p.m.", "Still, it rose."],
    "forms": ["It was bought by Ulm Inc.", "Margins held... for now, she wrote.", "Ost & Co. KG bids.", "The rest did not...", "A unit sold."],
    "quotes": ['"Is demand back?" asked Ulm.', 'He said: "Cash is fine."', "Then he left.", "“Nothing has changed.”", "(The table excludes it.)", "Who pays?!"],
    "german": ["Im 3. Quartal, d. h. am 5. März, fiel er um 3,5 Prozent bzw. ca. 2 Mio. Euro.", "„Die Lage ist stabil.“", "Der Fonds hält Aktien usw.", "Er fiel."],
    "french": ["« La dette recule. »", "Est-ce grave ?", "M. Ulm, cf. p. 2, a dit oui.", "Les réserves... n'ont pas bougé."],
    "spanish": ["El Sr. Ulm dimitió, p. ej. en la pág. 2.", "¡Nadie lo esperaba!", "Las acciones de Ulm S.A. cayeron.", "EE. UU. aplica un arancel."],
    "russian": ["Он ушёл в 2013 г. после проверки.", "См. стр. 4 отчёта.", "Фонд держит акции и т. д.", "Завод в г. Ульм закрыт!"],
    "hindi": ["डॉ. Ulm ने बोर्ड छोड़ दिया।", "क्या यह सुरक्षित है?", "शेयर 9.6% चढ़े।"],
    "arabic": ["قال د. Ulm إن الطلب تحسن.", "هل التوزيعات آمنة؟", "توقف المصنع!"],
    "lower case after a question": ["who sold 75 lots?", "can't fill at 36.2!", "brb"],
}


@pytest.mark.parametrize("name", CASES)
def test_spaced_scripts(name):
    assert cut(" ".join(CASES[name])) == CASES[name]
    # a single line end is plain white space
    assert cut("  \t" + "\n".join(CASES[name]) + "\n") == CASES[name]


def test_spaceless_scripts():
    zh = ["汇率影响有限；订单稳定。", "“成本还会下降。”Ulm先生说。", "“需求已经回来。”", "市场反应平淡……", "（见附注5。）", "工厂仍未复工！", "股价上涨18.3%。"]
    ja = ["「需要は戻った」", "「費用の見直しは続く。」とUlm氏は述べた。", "市場の反応は鈍い…。", "（詳細は注6を参照。）", "維持されるのか？"]
    assert cut("".join(zh)) == zh and cut("".join(ja)) == ja
    th = ["กองทุนถือ EQVBQ เป็นสัดส่วนสูง", "โรงงานยังปิดอยู่", "รายได้รวมอยู่ที่ 606 ล้านบาทต่ำกว่าที่คาด", "นักลงทุนรอดูผลประกอบการ"]
    assert cut(" ".join(th)) == th
    words = module.LISTED["Thai"]
    assert word_lattice("กองทุนถือxyzโรงงาน", words, 20) == ["กองทุน", "ถือ", "xyz", "โรงงาน"]


def test_layout():
    text = "RISK FACTORS\n\nFirst. Second\nline here.\n\nPositions:\n* Split 2-for-1 confirmed\n* Guidance unchanged.\n\n1. Summary\n\n \nLast"
    assert cut(text) == ["RISK FACTORS", "First.", "Second\nline here.", "Positions:", "* Split 2-for-1 confirmed", "* Guidance unchanged.", "1. Summary", "Last"]
    assert cut("due within 65 days.Ulmcowick Ltd. chairman left. See ir.ulm.example/docs.html for more.") == ["due within 65 days.", "Ulmcowick Ltd. chairman left.", "See ir.ulm.example/docs.html for more."]


def test_no_space_after_the_stop():
    assert cut("neue Zahlen bzw. Belege.Laut Nr. 2 des Berichts.") == ["neue Zahlen bzw. Belege.", "Laut Nr. 2 des Berichts."]
    assert cut('"We wait," said Mr. Ulm.Separately, he left.') == ['"We wait," said Mr. Ulm.', "Separately, he left."]
    assert cut("It lost bars for MZOGG/W. Others did not. See Mr.Ulm in prices_v2.6.parquet.") == ["It lost bars for MZOGG/W.", "Others did not.", "See Mr.Ulm in prices_v2.6.parquet."]


def test_nothing_and_very_long():
    assert cut("") == cut(" \n\t ") == [] and sentence_spans(None) == []
    long = "A b c. " * 20_000
    assert len(cut(long)) == 20_000
    assert cut("x" * 500_000) == ["x" * 500_000]
    assert cut("?!...") == ["?!..."] and cut("。。。") == ["。。。"]


def test_units_cover_all_but_white_space():
    for text in [" ".join(sum(CASES.values(), [])), 'a "b.) c\n\n* d\n"\ne. F (g! H', "「「。」x", "ก ข 1 ค . D"]:
        covered = set()
        for a, b in sentence_spans(text):
            assert text[a:b] == text[a:b].strip() and not covered & set(range(a, b))
            covered |= set(range(a, b))
        assert {i for i, c in enumerate(text) if not c.isspace()} <= covered


def test_blanks_of_any_length_after_the_end():
    for blanks in (" " * 199, " " * 200, "\t \n" + " " * 5_000):
        assert cut("One." + blanks + "Two." + blanks + "“Three!”" + blanks + "Four.") == ["One.", "Two.", "“Three!”", "Four."]
    assert cut("One." + " " * 500) == ["One."]


def test_words_are_told_from_the_whole_stretch(monkeypatch):
    seen = []
    monkeypatch.setattr(module, "word_lattice", lambda text, *rest: seen.append(text) or word_lattice(text, *rest))
    left, right = "กองทุนถือหุ้น" * 30, "โรงงานปิด" * 40
    assert cut(left + " " + right) == [left, right]
    assert seen == [left, right]


def test_abbreviations_that_no_list_has():
    # by their shape, by what follows, and by how the text writes them elsewhere
    for text in ("See hlm. 12 and blz. 12 or str. 12 of the note.", "They met Adm. Lee and Sgt. Pepper in town.", "Kgs. 12 went out with Lbt. Ulm at noon.", "He asked Cptn. Ahab twice."):
        assert cut(text) == [text]
    assert cut("We saw the pzk. 4 there. It held.") == ["We saw the pzk. 4 there.", "It held."]
    assert cut("It rose by 12 km. The rest fell.") == ["It rose by 12 km.", "The rest fell."]
    # the same word without a stop elsewhere is a word like others
    assert cut("A grdl of note. They kept the grdl. Ulm left.") == ["A grdl of note.", "They kept the grdl.", "Ulm left."]
    assert cut("Der 12. Bericht kam. Er fiel.") == ["Der 12. Bericht kam.", "Er fiel."]


def test_neighbours_decide_together():
    # a stop that is as likely an end as not is none inside an open bracket
    nodes = [(5, 6, 7, 1.0)]
    assert module._best_path("A (b c. D) e", nodes) == []
    assert module._best_path("A b c d. D e", [(7, 8, 9, 1.0)]) == [0]
    # of two doubtful stops with no word between, one ends
    assert module._best_path("One two. . Three four", [(7, 8, 9, 0.6), (9, 10, 11, 0.7)]) == [1]


def test_best_path_against_all_paths():
    rng = random.Random(3)

    def value(text, nodes, ends):
        total, at, words, depth = 0.0, 0, 0, 0
        for k, (_, end, then, score) in enumerate(nodes):
            piece = text[at:end]
            words, depth, at = words + len(piece.split()), max(0, depth + piece.count("(") - piece.count(")")), then
            if k in ends:
                total += score - (module.NO_WORD if not words else module.ONE_WORD if words == 1 else 0) - (module.OPEN_BRACKET if depth else 0)
                words = depth = 0
        return total

    for _ in range(200):
        pieces = ["".join(rng.choice(["a ", "b ", "(c ", "d) ", ""]) for _ in range(rng.randrange(1, 4))) + "x. " for _ in range(7)]
        text, nodes, at = "".join(pieces), [], 0
        for p in pieces:
            at += len(p)
            nodes.append((at - 2, at - 1, at, rng.choice([-3.0, -1.0, 0.3, 0.8, 1.5, 3.0, 8.0, -8.0])))
        best = max(value(text, nodes, {k for k in range(7) if m >> k & 1}) for m in range(128))
        assert abs(value(text, nodes, set(module._best_path(text, nodes))) - best) < 1e-9


def test_other_scripts_without_spaces():
    assert cut("ລາວໄປຕະຫຼາດແລ້ວ ແຕ່ຕະຫຼາດປິດຢູ່ມື້ນີ້ເດີ") == ["ລາວໄປຕະຫຼາດແລ້ວ", "ແຕ່ຕະຫຼາດປິດຢູ່ມື້ນີ້ເດີ"]
    assert cut("ລາວໄປຕະຫຼາດ ແລະຊື້ເຂົ້າ") == ["ລາວໄປຕະຫຼາດ ແລະຊື້ເຂົ້າ"]
    # scripts with terminators: a gap counts only in a block without any
    assert cut("គាត់ទៅផ្សារ និងទិញអង្ករ។ គាត់ត្រឡប់មកវិញ។") == ["គាត់ទៅផ្សារ និងទិញអង្ករ។", "គាត់ត្រឡប់មកវិញ។"]
    assert cut("今日は寒いですね 明日は晴れるでしょう") == ["今日は寒いですね", "明日は晴れるでしょう"]
    assert cut("今日は寒い ですね。明日は晴れる。") == ["今日は寒い ですね。", "明日は晴れる。"]


def test_thai_of_the_dictionary(spark):
    # no listed word: the dictionary of the platform segments, short pieces are an enumeration, whole clauses end
    lines = ["แอปเปิ้ล กล้วย ส้ม", "แมวสีดำนอนหลับบนเก้าอี้ไม้ตัวเก่า สุนัขวิ่งเล่นสนามหญ้าหน้าบ้านทุกเช้า"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {}
    for r in sentences(df).collect():
        got.setdefault(r.doc_id, []).append(lines[r.doc_id][r.sent_start : r.sent_end])
    assert got[0] == [lines[0]] and sorted(got[1]) == sorted(lines[1].split(" "))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([c for cs in CASES.values() for c in cs if c[-1] in ".!?"][:12]), min_size=2, max_size=5), st.integers(1, 700))
def test_boundaries_do_not_depend_on_the_run_of_blanks(pieces, blanks):
    one = cut(" ".join(pieces))
    many = cut((" " * blanks).join(pieces))
    assert ["".join(x.split()) for x in one] == ["".join(x.split()) for x in many]


def test_table(spark):
    df = spark.createDataFrame([(1, "One. Two.", "x"), (2, None, "x"), (3, "", "x"), (4, "😂 so. Y", "x"), (1, "One. Two.", "x")], "doc_id long, text string, sent_start string")
    got = sorted(map(tuple, sentences(df).collect()))
    assert got == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9), (4, 0, 1), (4, 2, 5), (4, 6, 7)]
    assert sentences(df.limit(0)).count() == 0
