import re

from pyspark.sql import functions as F

from lexigrid.functions import text as tx


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(fn(F.col("t")).alias("r")).first()["r"]


def python_char_wb(text, lo, hi):
    out = []
    for w in re.sub(r"\s\s+", " ", text.lower()).split():
        w = f" {w} "
        for n in range(lo, hi + 1):
            out.append(w[:n])
            pos = 0
            while pos + n < len(w):
                pos += 1
                out.append(w[pos : pos + n])
            if pos == 0:
                break
    return sorted(out)


def test_tokenizers(spark):
    assert one(spark, " Olá, Mundo x ", tx.ws_tokens) == ["olá,", "mundo", "x"]
    assert one(spark, "Olá, a Mundo_1 é x2!", tx.word_tokens) == ["olá", "mundo_1", "x2"]
    assert one(spark, "", tx.ws_tokens) == []


def test_clean_tokens_delete_without_space(spark):
    assert one(spark, "Isto é a1b2c um-teste, SÃO 12 não!", tx.clean_tokens) == ["isto", "abc", "umteste", "não"]


def test_word_ngrams(spark):
    assert one(spark, "aa bb cc", lambda c: tx.word_ngrams(tx.word_tokens(c), 1, 3)) == [
        "aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc",
    ]
    assert one(spark, "aa", lambda c: tx.word_ngrams(tx.word_tokens(c), 2, 5)) == []


def test_char_ngrams_collapse_runs_and_count_code_points(spark):
    assert one(spark, "aB  c", lambda c: tx.char_ngrams(c, 3, 3)) == ["ab ", "b c"]
    assert one(spark, "a\U0001f600bc", lambda c: tx.char_ngrams(c, 2, 2)) == ["a\U0001f600", "\U0001f600b", "bc"]
    assert one(spark, "x\ny", lambda c: tx.char_ngrams(c, 3, 3)) == ["x\ny"]


def test_char_wb_matches_plain_definition(spark):
    for text in ("a bcd  Efghij\nk", "", "ab", "não é"):
        for lo, hi in ((3, 5), (4, 6), (1, 3), (6, 9)):
            got = one(spark, text, lambda c, lo=lo, hi=hi: tx.char_wb_ngrams(c, lo, hi))
            assert sorted(got) == python_char_wb(text, lo, hi), (text, lo, hi)


def test_strip_accents(spark):
    assert one(spark, "ÀÉîõüçñß é", tx.strip_accents) == "AEioucnß e"
    assert one(spark, "ﬁm ã … ½ ™ é\u0301", tx.strip_accents) == "fim a ... 1\u20442 TM e"


def test_stop_words_keep_duplicates(spark):
    assert one(spark, "casa de casa", lambda c: tx.drop_stop_words(tx.ws_tokens(c), tx.STOP_PT)) == ["casa", "casa"]


def test_portuguese_list_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    words = StopWordsRemover.loadDefaultStopWords("portuguese")
    assert one(spark, "ele quer casa", lambda c: tx.drop_stop_words(tx.ws_tokens(c), words)) == ["quer", "casa"]


def test_flags(spark):
    cases = {
        "has_pesquisa": ("Minha PESQUISA.", "pesquisador"),
        "has_universidade": ("na ufsp", "tarifa"),
        "has_empresa": ("a empresa", "empresas"),
        "has_servidor": ("funcionário público", "servidora"),
        "has_processo": ("processo", "éprocesso"),
        "has_contrato": ("(contrato)", "contratos"),
        "has_obrigado": ("Obrigada!", "obrigados"),
        "has_cnpj": ("12.345.678/0001-99", "12.345.678/001-99"),
        "has_email_gov": ("x@y.gov.br", "x@y\ngov.br"),
        "has_email_edu": ("x@y.edu.br", "edu.br"),
    }
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in cases.items()], "k string, yes string, no string")
    for row in df.select("k", F.struct(*tx.regex_flags(F.col("yes"))).alias("y"), F.struct(*tx.regex_flags(F.col("no"))).alias("n")).collect():
        assert row["y"][row["k"]] is True, row["k"]
        assert row["n"][row["k"]] is False, row["k"]
    none = spark.createDataFrame([(None,)], "t string").select(*tx.regex_flags(F.col("t"))).first()
    assert not any(none)


def test_null_becomes_empty(spark):
    assert one(spark, None, tx.as_text) == ""
    assert one(spark, None, lambda c: tx.analyze(c, "char", (3, 3))) == []
