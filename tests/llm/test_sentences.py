import random
import time

import pytest

from brightledger.llm.sentences import HEADS, OPENERS, lattice, sentence_spans, span_loss, split_sentences


def units(text):
    return [text[a:b] for a, b in sentence_spans(text)]


CASES = [
    ["Dr. Reyes noted that 3 of 4 units failed.", "The unit price fell from 4.50 to 3.75 per kg. after the canvass."],
    ["Lot 3 went to Acme Inc.", "Form 2.7.9 replaced v6.4 on 3 Sept. 2016.", "Why?!", "It closed at 3 p.m."],
    ['"We will not extend it. Please file on time," said Atty. Cruz.', '"Is it valid?" asked the chair, but nobody answered.'],
    ["The panel wrote: “Rejected! Resubmit by 5 p.m.” and adjourned.", "(The abstract is filed under 5.)", "Offers in U.S. dollars, incl. those from Acme, will be returned to Ms. Tan."],
    ["The observer left early... and did not sign.", "J. R. Cruz and M. T. Diaz signed."],
    ["Am 8. Mai wurden 20 Angebote geöffnet.", "Der 2. Termin entfällt!", "„Die Frist bleibt. Bitte liefern“, sagte Frau Ott."],
    ["¿Quién firmó el acta núm. 5?", "¡Quedó desierta!", "«No habrá prórroga. Entreguen», dijo la Dra. Paz."],
    ["Ποιος υπέγραψε την ανακοίνωση αρ. 5;", "Η εταιρεία αποσύρθηκε· έμεινε μία προσφορά."],
    ["هل وقّع السيد على الإشعار رقم 5؟", "قال د. سامي: «لن نمدد الموعد. سلّموا العروض»، ثم أغلق الملف."],
    ["क्या श्री राम ने सूचना सं. 5 पर हस्ताक्षर किए?", "अनुबंध सं. 6 का मूल्य रु. 4 है।"],
    ["ዋጋው ቀንሷል፤ ውሉም ተፈርሟል።", "ዶ/ር ካሳ አሉ።"],
]


@pytest.mark.parametrize("parts", CASES)
def test_spaced_scripts(parts):
    assert units(" ".join(parts)) == parts
    assert units("\n".join(parts)) == parts
    assert units("\n\n".join(parts)) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["谁签署了第5号通知？", "由于公司退出……委员会决定重新招标。", "“截止日期不会延长。请提交。”王先生在会上说。", "里卡问道：“还有效吗？”", "采购编号5的合同已于2015年签订。"],
        ["応札者は一社だけだった！", "「延長しません。早めに提出してください。」とタナカ氏は述べた。", "担当のサトさんは「有効ですか？」と尋ねた。"],
    ],
)
def test_unspaced_scripts(parts):
    assert units("".join(parts)) == parts


def test_thai_blanks():
    assert units("สัญญาเลขที่ 5 ของบริษัท Acme หมดอายุแล้ว ให้ส่งมอบภายใน 3 วันทำการ") == ["สัญญาเลขที่ 5 ของบริษัท Acme หมดอายุแล้ว", "ให้ส่งมอบภายใน 3 วันทำการ"]


def test_lists_headings_and_wrapped_lines():
    assert units("NOTICE OF AWARD\n1. 4 pcs. tires\n(b) steel bars, approx. 5.5 kg\n- Acme: PHP 5\nThe end.") == ["NOTICE OF AWARD", "1. 4 pcs. tires", "(b) steel bars, approx. 5.5 kg", "- Acme: PHP 5", "The end."]
    wrapped = "The contract covers hand tractors, spare parts, etc. as stated. The second\nsentence of this text is broken by its width, and the line break in it is\nno end. Done."
    assert units(wrapped) == ["The contract covers hand tractors, spare parts, etc. as stated.", wrapped[64:-6], "Done."]


def test_no_blank_after_the_mark():
    assert units("It could wait.Did he sign?Yes.") == ["It could wait.", "Did he sign?", "Yes."]


def test_lower_case_text():
    assert units("this office may wait. please refer to pp. 3-4 of the minutes. why was it posted?") == ["this office may wait.", "please refer to pp. 3-4 of the minutes.", "why was it posted?"]


@pytest.mark.parametrize("text", [None, "", " ", "\n\t  ", "　"])
def test_no_content(text):
    assert sentence_spans(text) == []


def test_every_character_lies_in_one_unit():
    for text in [" ".join(sum(CASES, [])), "a" * 5000, "A. " * 3000, '"' * 7 + " x. Y", "...", "?!", "(a", "x)\n\n\ny", "1.", "a\r\nb.\r\n\r\nC"]:
        spans = sentence_spans(text)
        covered = [False] * len(text)
        for a, b in spans:
            assert a < b and not text[a].isspace() and not text[b - 1].isspace()
            for i in range(a, b):
                assert not covered[i]
                covered[i] = True
        assert all(c or t.isspace() for c, t in zip(covered, text))


def test_operator(spark):
    rows = [(1, "One. Two.", "x"), (2, None, "x"), (3, " ", "x"), (1, "One. Two.", "x"), (None, "Three", "x"), (4, "Long one here. " * 20_000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, begin_pos string")
    got = split_sentences(df)
    assert got.columns == ["doc_id", "begin_pos", "end_pos"] and got.filter("doc_id = 4").count() == 20_000
    assert sorted((r.doc_id or 0, r.begin_pos, r.end_pos) for r in got.filter("coalesce(doc_id, 0) < 4").collect()) == [(0, 0, 5), (1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9)]
    assert split_sentences(df.limit(0)).count() == 0


def test_a_unit_may_hold_any_number_of_stops():
    parts = ["The lots came to " + ", ".join(f"{k}.5 and {k}.25" for k in range(100, 300)) + " in all.", "It closed."]
    assert units(" ".join(parts)) == parts


def test_lattice_against_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randint(1, 120)
        most = rnd.choice([6, 60])
        ends, starts, at = [], [0], 0
        for _ in range(n):
            at += rnd.randint(1, most)
            ends.append(at)
            at += rnd.randint(0, 2)
            starts.append(at)
        starts.pop()
        score = [rnd.choice([-9.0, -5.0, -2.0, 2.0, 5.0]) for _ in ends]
        a, b = ([(rnd.choice([0, 0, 0, 1]), rnd.choice([0, 0, 1])) for _ in ends] for _ in "ab")
        has = [rnd.random() < 0.4 for _ in ends]
        before = [sum(has[:k]) for k in range(n + 1)]
        best = [0.0]
        for j in range(n):
            best.append(max(best[i] + score[j] - span_loss(ends[j] - starts[i], b[j] == a[i], any(has[i : j + 1])) for i in range(j + 1)))
        got, back = lattice(starts, ends, score, a, b, before[:-1], before[1:])
        assert all(abs(x - y) < 1e-9 for x, y in zip(got, best)) and all(i <= j for j, i in enumerate(back))


def test_wide_units_are_whole():
    for n in (70, 100, 2000):
        text = " ".join(["The panel heard"] + ["Dr. Cruz,"] * n + ["and Dr. Tan."])
        assert units(text + " It closed.") == [text, "It closed."]


def test_spaced_leaders_do_not_end_a_unit():
    assert units("Offers were read: . . . none was late.") == ["Offers were read: . . . none was late."]


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "\n".join(f"- item {i} of the list" for i in range(n)),
        lambda n: "\n".join(f"plain line {i} without a mark" for i in range(n)),
        lambda n: "He said “go”. " * n,
        lambda n: ". . . " * n,
        lambda n: "5; 6; " * n,
    ],
)
def test_work_is_linear(make):
    def took(n):
        text = make(n)
        times = []
        for _ in range(3):
            began = time.process_time()
            sentence_spans(text)
            times.append(time.process_time() - began)
        return min(times)

    took(200)
    assert took(16000) < 8 * took(4000) + 0.05  # four times the text; quadratic work takes sixteen times as long




# Labelled units, none of which begins with a word on the module's lists of openers.
LABELLED = {
    "en": ["Mayor Lindqvist opened bidding on 14 March 2023.", "Suppliers paid 3.75 per kg. to Acme Corp. after tests.", "Gravel prices rose 12.5% within weeks!", "Has Prof. Okafor signed both copies?", 'Witness Marlow replied, "Nothing was missing." and sat down.',
           "Engineers measured 4 ft. of water near Bridge No. 7.", "Trucks left at 6 a.m. sharp.", "Costs (see p. 12) doubled.", "Judge Adeyemi and J. P. Moreau abstained.", "Few objected… so voting began."],
    "es": ["Ingenieros revisaron 3 puentes en abril.", "¿Quedan fondos para pintura?", "Nuestra oficina pagó 1.250,50 euros al Sr. Ibáñez.", "¡Felicitaciones a todo equipo!", "Doña Marta dijo: «Firmaremos mañana»."],
    "de": ["Bauleiter Krüger kam am 3. Oktober zurück.", "Kosten stiegen z. B. um 4,5 Prozent.", "Wurde Beton bestellt?", "Frau Dr. Weiß unterschrieb.", "Lieferungen enden bald!"],
    "el": ["Εργάτες έφτασαν νωρίς.", "Πόσα φορτηγά χρειάζονται;", "Ξεκίνησαν έργα αξίας 4,5 εκατ. ευρώ."],
    "ar": ["وصلت الشاحنات مبكرا.", "كم شاحنة نحتاج؟", "بدأ العمل يوم 5 مارس."],
    "hi": ["ट्रक जल्दी पहुँचे।", "कितने मजदूर चाहिए?", "काम 5 मार्च को शुरू हुआ।"],
    "am": ["ሰራተኞች ቀድመው ደረሱ።", "ስንት መኪና ያስፈልጋል?", "ሥራው ተጀመረ።"],
    "zh": ["卡车提前到达。", "需要多少工人？", "王经理说：“明天开工。”", "费用为3.5万元！"],
    "ja": ["トラックは早く着いた。", "作業員は何人必要ですか？", "費用は3.5万円です。"],
}


def labelled(seed, n=300):
    """Texts of random units with their spans: parted by blanks (none in Chinese and Japanese), line breaks or blank lines, some in one letter case."""
    rnd = random.Random(seed)
    for _ in range(n):
        lang = rnd.choice(list(LABELLED))
        parts = [rnd.choice(LABELLED[lang]) for _ in range(rnd.randint(1, 9))]
        if lang in ("en", "es", "de") and rnd.random() < 0.15:
            parts = [p.upper() for p in parts]
        text, spans = "", []
        for p in parts:
            spans.append((len(text), len(text) + len(p)))
            text += p + rnd.choice(["" if lang in ("zh", "ja") else " ", "" if lang in ("zh", "ja") else " ", "\n", "\n\n"])
        yield lang, text, spans


def test_recall_and_precision_on_labelled_units():
    assert not {p.split()[0].strip("¿¡«“").casefold() for parts in LABELLED.values() for p in parts} & (OPENERS | HEADS)
    right, true, found = {}, {}, {}
    for lang, text, spans in labelled(12):
        got = set(sentence_spans(text))
        for count, x in ((right, len(got & set(spans))), (true, len(spans)), (found, len(got))):
            count[lang] = count.get(lang, 0) + x
    for lang in LABELLED:
        recall, precision = right[lang] / true[lang], right[lang] / found[lang]
        print(lang, true[lang], round(recall, 3), round(precision, 3))
        assert recall >= 0.95 and precision >= 0.95, (lang, recall, precision)
