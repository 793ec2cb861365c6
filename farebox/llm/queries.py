"""The text and vector operators as queries over the given tables, and their SQL twins."""

from __future__ import annotations

from farebox.llm import decontaminate, lines, mixing, negatives, pieces, pii, quality, rules, simhash, tokens, toxicity, urls, whitening
from farebox.tables import Tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame``; these queries stay apart from the library's own catalogue."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query("op1_toxicity")
def op1(t: Tables):
    return toxicity.classify(t.documents, t.labels)


@query("op2_simhash")
def op2(t: Tables):
    return simhash.near_duplicates(t.documents)


@query("op3_quality")
def op3(t: Tables):
    return quality.classify(t.documents, t.labels)


@query("op4_token_counts")
def op4(t: Tables):
    import public_tokenizers

    return tokens.count_tokens(t.documents, public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_mixing", mixing.ORACLE)
def op5(t: Tables):
    return mixing.mix(t.documents)


@query("op6_quality_rules", rules.ORACLE)
def op6(t: Tables):
    return rules.judge(t.documents)


@query("op7_line_dedup", lines.ORACLE)
def op7(t: Tables):
    return lines.judge(t.documents)


@query("op8_url_filter")
def op8(t: Tables):
    return urls.judge(t.pages)


@query("op9_decontamination", decontaminate.ORACLE)
def op9(t: Tables):
    return decontaminate.judge(t.documents, t.benchmark)


@query("op10_pii")
def op10(t: Tables):
    return pii.judge(t.documents)


@query("op11_hard_negatives", negatives.ORACLE)
def op11(t: Tables):
    return negatives.judge(t.embeddings)


@query("op12_sentencepiece")
def op12(t: Tables):
    import public_tokenizers

    return pieces.judge(t.documents, public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_whitening")
def op13(t: Tables):
    return whitening.judge(t.embeddings)
