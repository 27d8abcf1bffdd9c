"""Problems 1, 6 and 8: rules on single texts."""

import pytest
from pyspark.sql import functions as F

from curata.llm import defects, encode, pii

PROMPT = "Explain why the index map becomes stale when we pin the tile, and say what happens to the mask in the first run."
ANSWER = "The mask is applied after the load, so the index map is read twice and the tile is stale."


def check(text, prompt=PROMPT, field="response", task=None):
    return defects.defects_of(field, text, defects.prompts_of(prompt, task))


@pytest.mark.parametrize("text", [None, "", " \t\n", "​", "-", "…", "N/A", "None", "(empty)", "[no output]", "```\n```", "```python\n\n```", "<think>\n\n</think>", "{}", "TODO"])
def test_empty(text):
    assert check(text) == ["empty"]


def test_empty_reasoning():
    assert check(None, field="reasoning") == check(" ", field="reasoning") == [] and check("n/a", field="reasoning") == ["empty"]


@pytest.mark.parametrize("text", ["54", "#### 7203", "`tile = 4`", "Yes.", "-3.5", ANSWER, ANSWER + "\n\n```python\nx = 1\n```", ANSWER + "\n\n#### 18", "I cannot stress enough that the mask is applied after the load.", "I'm sorry the first draft failed, here is the corrected version of the tile."])
def test_sound(text):
    assert check(text) == []


@pytest.mark.parametrize("text", ["> " + PROMPT, PROMPT.upper(), "You asked: " + PROMPT, "\n".join(PROMPT.split()), PROMPT + "\n" + PROMPT])
def test_copy(text):
    assert check(text) == ["copy"]


def test_quoted_prompt_with_answer():
    assert check("> " + PROMPT + "\n\n" + ANSWER) == []
    assert check(PROMPT, prompt="wrapper text of a repair", task=PROMPT) == ["copy"]


@pytest.mark.parametrize(
    ("text", "prompt"),
    [
        ("I'm sorry, but I can't help with this request.", PROMPT),
        ("To be upfront, I must decline to answer and I hope you understand.", PROMPT),
        ("Leider muss ich die Antwort ablehnen, da mir die Verwendung unklar ist.", "Warum ist die Maske nicht an der Stelle, die wir im Test sehen?"),
        ("Je suis désolé, mais je ne peux pas vous aider.", "Pourquoi la tuile est-elle trop large quand on la lit deux fois ?"),
        ("Lo siento, pero no puedo ayudar con esto.", "¿Por qué queda la máscara fuera de la fila cuando la aplicamos?"),
    ],
)
def test_refusal(text, prompt):
    assert check(text, prompt) == ["refusal"]


def test_language():
    german = "Die Maske wird nach dem Laden angewandt, und die Kachel ist nicht mehr gepuffert, wenn wir sie mit dem Test vergleichen."
    assert check(german) == ["language"] and check(german, PROMPT + " Answer in German, please.") == [] and check(german, PROMPT + " Answer in French.") == ["language"]
    assert check(german, None) == [] and check("Маска применяется после загрузки, и плитка больше не хранится.") == ["language"]
    assert check("```python\n# und der die das ist nicht\nx = 1\n```\nIt is the tile.") == []


@pytest.mark.parametrize("text", [ANSWER[:-20].rstrip(), ANSWER + " The mask (", ANSWER + "\n\n```python\nx = 1\n", ANSWER + " So it,", ANSWER + " It holds 53"])
def test_truncated(text):
    assert check(text) == ["truncated"]


def test_two_defects():
    assert check("Die Maske wird nach dem Laden angewandt, und die Kachel ist nicht mehr gepuffert, wenn wir sie mit der") == ["language", "truncated"]


def test_unclosed():
    for text in ("subtract the max (which keeps exponents bounded. Then divide by the sum.", "{'a': 1, 'b': [2, 3. That is all.", "<think>we look at the mask. It is stale.", "He says “the tile is stale. It is read twice."):
        assert check(text) == ["truncated"]
    for text in ("It holds: a) the tile, b) the mask. See (above) :) in the note.", "Call `f(` first, then the rest of the tile.", "A bracket] without an opener is a typing slip here."):
        assert check(text) == []


def test_refusals_of_other_forms():
    for text in ("Sorry, that request goes against my guidelines.", "I don't have the ability to do that.", "Извините, но я не могу помочь с этим запросом.", "申し訳ありませんが、お手伝いできません。", "抱歉，我无法回答这个问题。"):
        assert check(text) == ["refusal"]


def test_every_triggered_defect():
    russian = defects.defects_of("response", "Извините, но я не могу помочь с этим (запросом.", defects.prompts_of(PROMPT), every=True)
    assert russian == ["refusal", "language", "truncated"]
    assert defects.defects_of("response", PROMPT[:-1], defects.prompts_of(PROMPT), every=True) == ["copy", "truncated"]


def test_defect_table(spark):
    schema = "traj_id long, prompt string, response string, reasoning string, metadata struct<prompt_meta:struct<prompt:string>>, field string, defect string"
    rows = [(1, PROMPT, None, None, None, "x", "y"), (1, PROMPT, None, None, None, "x", "y"), (None, None, None, None, None, None, None), (2, PROMPT, ANSWER, PROMPT, None, None, None), (3, PROMPT, ANSWER + " word" * 300_000, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    assert {tuple(r) for r in defects.found(df).collect()} == {(1, "response", "empty"), (2, "reasoning", "copy"), (3, "response", "truncated")}
    assert defects.found(df.limit(0)).count() == 0


TEXTS = ["", None, "hello world", "<|endoftext|> is text", "é ü  x\r\n\t", " ", "a" * 70_000, "word and " * 20_000, "it's 5's don't " * 3000, "\U0001f600 核の境界", "  lead and trail  "]


def test_encoding(spark):
    tokenizers = pytest.importorskip("tokenizers")
    whole = tokenizers.Tokenizer.from_file(encode.RANK_FILE.replace(".tiktoken", ".json"))
    whole.encode_special_tokens = True
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("ids", F.lit(1)).drop("ids")
    got = {r["doc_id"]: list(r["ids"]) for r in encode.encode_documents(df).collect()}
    assert got == {k: whole.encode(t, add_special_tokens=False).ids if t else [] for k, t in enumerate(TEXTS)}
    assert all(r["same"] for r in encode.round_trip(df).collect())
    assert "".join(encode.pieces("a bc  d " * 20_000)) == "a bc  d " * 20_000 and len(encode.pieces("a bc  d " * 20_000)) > 5
    assert encode.encode_documents(df.limit(0)).count() == 0


LEXICON = [("Grace", "given"), ("Stone", "family"), ("Illmensee", "family"), (None, None)]
ANCHORS = pii.Anchors([x for x in LEXICON if x[0]])


@pytest.mark.parametrize(
    ("text", "pieces"),
    [
        ("Questions go to grace_q@kernels.test; answers take a day.", [("email", "grace_q@kernels.test")]),
        ("Reach the owner at owen.f at example dot com, please.", [("email", "owen.f at example dot com")]),
        ("mail x [at] post.invalid or A @ B.example", [("email", "x [at] post.invalid"), ("email", "A @ B.example")]),
        ("Keep @triton.jit and cache@v85, bundle-87@sha256:3d817dc8.", []),
        ("Call (847) 555-0180 or +44 20 7946 0177.", [("phone", "(847) 555-0180"), ("phone", "+44 20 7946 0177")]),
        ("appelez le 0199007699 ou 01 99 00 09 74", [("phone", "0199007699"), ("phone", "01 99 00 09 74")]),
        ("Ticket 2026-51-8434, table 70-76-6748, sweep 768-2048-160, seed=22855986268", []),
        ("SSN 962-00-3362 and soc. sec. no. 940007990 again", [("id_number", "962-00-3362"), ("id_number", "940007990")]),
        ("NINO: qq 61 75 49 D, DNI 44803010-D, Steuer-ID 07 156 752 657", [("id_number", "qq 61 75 49 D"), ("id_number", "44803010-D"), ("id_number", "07 156 752 657")]),
        ("Deliver to: 55B Ferry Stile Way, flat 3", [("address", "55B Ferry Stile Way")]),
        ("Le bureau se trouve 81 chemin des Tisserands-Bleus.", [("address", "81 chemin des Tisserands-Bleus")]),
        ("Das Büro liegt in der Amselgrundweg 131a. Calle Tejedores, n.º 86, Ostheim", [("address", "Amselgrundweg 131a"), ("address", "Calle Tejedores, n.º 86")]),
        ("Take 36 Fast Lane samples, then Lane 75 and Path 65.", []),
        ("Thanks to Hunter Vintermark for the trace. Ms Grace Stone will answer", [("name", "Hunter Vintermark"), ("name", "Grace Stone")]),
        ("Herr Illmensee, Horst hat den Lauf gestartet.", [("name", "Illmensee, Horst")]),
        ("Signed-off-by: M. Stone", [("name", "M. Stone")]),
        ("M. Grace Stone a signé le manifeste. The Ring Buffer and the Cold Start stay.", [("name", "Grace Stone")]),
        ("", []),
    ],
)
def test_pieces(text, pieces):
    assert [(k, text[s:e]) for s, e, k in pii.pieces(text, ANCHORS)] == pieces


@pytest.mark.parametrize(
    ("text", "pieces"),
    [
        ("Kim Lee measured the tile twice.", [("name", "Kim Lee")]),
        ("Yesterday it failed. Priya Raman audited the tile.", [("name", "Priya Raman")]),
        ("Dr. Ada Lovelace and Prof. Alan Turing met Grace Hopper.", [("name", "Ada Lovelace"), ("name", "Alan Turing"), ("name", "Grace Hopper")]),
        ("Contact: Maria Rossi <m.rossi@uni.test>", [("name", "Maria Rossi"), ("email", "m.rossi@uni.test")]),
        ("Ich heiße Anna Schmidt und komme aus Bonn.", [("name", "Anna Schmidt")]),
        ("The Ring Buffer keeps the tile. On Blackwell it is. Beide Varianten stimmen. Apache Spark runs.", []),
        ("My SSN is 900-12-3456 and the passport no. is X1234567", [("id_number", "900-12-3456"), ("id_number", "X1234567")]),
        ("IBAN DE89 3704 0044 0532 0130 00, or GB82WEST12345698765432, GB82 WEST 1234 5698 7654 32.", [("id_number", "DE89 3704 0044 0532 0130 00"), ("id_number", "GB82WEST12345698765432"), ("id_number", "GB82 WEST 1234 5698 7654 32")]),
        ("GB83WEST12345698765432 fails its check digits", []),
        ("account number 12345678, sort code 12-34-56", [("id_number", "12345678"), ("id_number", "12-34-56")]),
        ("get ftp://joe:pw@host.example/x now, see https://x.test/?m=joe@y.test", [("email", "joe@y.test")]),
        ("write to a.very@" + "x" * 40 + "." + "y" * 60 + "." + "z" * 60 + ".example today", [("email", "a.very@" + "x" * 40 + "." + "y" * 60 + "." + "z" * 60 + ".example")]),
        ("Der Sitz ist Via Roma 12, Milano", [("address", "Via Roma 12")]),
        ("She is at 221B Baker Street and works there. Take 36 Fast Lane samples.", [("address", "221B Baker Street")]),
        ("tel:+442079460018 ip 192.168.100.200 date 2026-05-12 10:22:33 v1.22.333", [("phone", "+442079460018")]),
    ],
)
def test_pieces_of_other_texts(text, pieces):
    assert [(k, text[s:e]) for s, e, k in pii.pieces(text, ANCHORS)] == pieces


@pytest.mark.parametrize("part", ["a@", "1 ", "12-34 ", "Grace ", "x at ", " street", "a.b.", "9", "\n", "Best\n", "from: ", "Am ", "A-", "x@a."])
def test_long_texts_take_linear_time(part):
    import time

    def seconds(n):
        began = time.process_time()
        pii.pieces(part * n, ANCHORS)
        return time.process_time() - began

    assert seconds(16_000) < 0.5 + 20 * seconds(2_000)


def test_a_missing_vocabulary_is_an_error(tmp_path):
    (tmp_path / "empty").touch()
    (tmp_path / "broken").write_text("IHRoZQ==\n")
    for name, error in (("missing", FileNotFoundError), ("empty", ValueError), ("broken", ValueError)):
        for files in ((encode.RANK_FILE, str(tmp_path / name)), (str(tmp_path / name), encode.MULTI_RANK_FILE)):
            with pytest.raises(error):
                pii.Anchors(LEXICON[:3], files)


def test_masking(spark):
    df = spark.createDataFrame([(1, "Ask Grace Stone, g@x.test."), (2, None), (3, ""), (None, "g@x.test"), (1, "Ask Grace Stone, g@x.test."), (4, "g@x.test " * 50_000)], "doc_id long, text string").withColumn("kind", F.lit(0))
    lexicon = spark.createDataFrame(LEXICON, "token string, kind string")
    assert {tuple(r) for r in pii.found(df, lexicon).collect()} == {(1, "name", "Grace Stone"), (1, "email", "g@x.test"), (4, "email", "g@x.test")}
    shown = {r["doc_id"]: r["masked"] for r in pii.masked(df.where("doc_id < 4"), lexicon).collect()}
    assert shown == {1: "Ask [NAME], [EMAIL].", 2: None, 3: ""}
    assert pii.found(df.limit(0), lexicon).count() == 0 and pii.found(df, lexicon.limit(0)).where("kind = 'email'").count() == 2
