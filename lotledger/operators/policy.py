"""Text policy, request rules and intent routing as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import sanitize, strip

MAX_TEXT_LENGTH = 1000

# Personal-data patterns by type.
PII_PATTERNS = {
    "cpf": r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b",
    "cnpj": r"\b\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}\b",
    "email": r"\b[\w.+-]+@[\w-]+(?:\.[\w-]+)+\b",
    "telefone": r"\b(?:\+?55\s?)?(?:\(?\d{2}\)?\s?)?9?\d{4}-?\d{4}\b",
}
# Attempts to override instructions.
INJECTION_PATTERNS = (
    r"ignore\s+(all\s+)?(previous|prior|above)\s+instructions",
    r"ignore\s+(as\s+)?instru[cç][oõ]es\s+(anteriores|acima)",
    r"desconsidere\s+(as\s+)?instru[cç][oõ]es",
    r"system\s+prompt",
    r"prompt\s+(do\s+)?sistema",
    r"developer\s+message",
    r"mensagem\s+do\s+desenvolvedor",
    r"reveal\s+(the\s+)?prompt",
    r"mostre\s+(o\s+)?prompt",
    r"exfiltrat",
    r"jailbreak",
    r"fa[cç]a\s+de\s+conta\s+que\s+voc[eê]\s+agora\s+[eé]",
    r"force\s+(the\s+)?tool",
    r"chame\s+(a\s+)?tool",
    r"execute\s+(a\s+)?tool",
)
# Secrets and off-domain requests.
OFF_DOMAIN_PATTERNS = (
    r"\b(senha|password|token|api[_ -]?key|secret|segredo)\b",
    r"\b(cart[aã]o\s+de\s+cr[eé]dito|credit\s+card)\b",
)
# Replies that give away instructions.
LEAKAGE_PATTERNS = (
    r"\bsystem\s+prompt\b",
    r"\bdeveloper\s+message\b",
    r"\bprompt\s+(oculto|interno|do\s+sistema)\b",
    r"\binstru[cç][oõ]es\s+(ocultas|internas|do\s+sistema)\b",
)
# Replies that promise certainty.
CERTAINTY_PATTERNS = (
    r"\bpre[cç]o\s+garantido\b",
    r"\bvalor\s+garantido\b",
    r"\bgarantia\s+de\s+valor\b",
    r"\bcerteza\s+(jur[ií]dica|financeira)\b",
    r"\bdecis[aã]o\s+financeira\s+definitiva\b",
    r"\brentabilidade\s+garantida\b",
)
# Message shown for each refusal and for a withheld reply.
REFUSAL_MESSAGES = {
    "input_too_long": "Texto acima do limite permitido",
    "prompt_injection_detected": "Entrada bloqueada por politica de prompt injection",
    "pii_detected": "Entrada bloqueada por politica de PII",
    "unsafe_secret_or_off_domain_request": "Entrada fora do escopo seguro do sistema",
}
OTHER_REFUSAL = "Entrada bloqueada por politica de seguranca"
WITHHELD_REPLY = (
    "A resposta foi bloqueada por uma politica de seguranca. "
    "Refaca a pergunta sem dados pessoais, secrets ou pedidos fora do escopo."
)
# Record fields whose text is screened.
TEXT_FIELDS = ("message", "query", "prompt", "question", "text")
# Words that mark a failing model provider.
PROVIDER_MARKERS = ("groq", "llm", "provider", "api key", "rate limit", "quota", "timeout")

# Keywords of each routing step.
PRICE_KEYWORDS = (
    "estime", "estimar", "quanto vale", "quanto custa", "qual o preco", "qual o preço", "preco desse", "preço desse",
    "valor estimado", "precificar",
)
TOOL_KEYWORDS = (
    "estime", "estimar", "quanto vale", "quanto custa", "qual o preco", "qual o preço", "preco desse", "preço desse",
    "compare", "comparar",
)
COMPARE_KEYWORDS = ("compare", "comparar", "comparacao", "comparação")
SEARCH_KEYWORDS = ("fatores", "influenciam", "explique", "explicar", "como funciona", "documento", "contexto", "rag")
FALLBACK_PRICE_KEYWORDS = (
    "estime", "estimar", "quanto vale", "quanto custa", "qual o preco", "qual o preço", "preco para cep",
)


def any_match(text: Column, patterns: Sequence[str]) -> Column:
    """One case-insensitive, Unicode-aware alternation over all patterns."""
    return text.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in patterns))


def pii_types(text: Column) -> Column:
    """Sorted personal-data types found; the values are never returned."""
    found = [F.when(any_match(text, [p]), F.lit(name)) for name, p in sorted(PII_PATTERNS.items())]
    return F.array_compact(F.array(*found))


def is_injection(text: Column) -> Column:
    return F.coalesce(any_match(text, INJECTION_PATTERNS), F.lit(False))


def is_off_domain(text: Column) -> Column:
    return F.coalesce(any_match(text, OFF_DOMAIN_PATTERNS), F.lit(False))


def _verdict(reason: Column, shown: Column) -> Column:
    return F.struct(reason.isNull().alias("allowed"), reason.alias("reason"), shown.alias("sanitized_text"))


def input_verdict(text: Column, max_length: int = MAX_TEXT_LENGTH) -> Column:
    """Struct (allowed, reason, sanitized_text); the first rule that matches wins."""
    clean = sanitize(text)
    types = pii_types(clean)
    reason = (
        F.when(clean == "", "input_empty")
        .when(F.length(clean) > max_length, "input_too_long")
        .when(is_injection(clean), "prompt_injection_detected")
        .when(F.size(types) > 0, F.concat(F.lit("pii_detected:"), F.array_join(types, ",")))
        .when(is_off_domain(clean), "unsafe_secret_or_off_domain_request")
    )
    return _verdict(reason, clean)


def output_verdict(text: Column) -> Column:
    """Struct (allowed, reason, sanitized_text) for a reply."""
    clean = strip(F.coalesce(text, F.lit("")))
    types = pii_types(clean)
    reason = (
        F.when(clean == "", "output_empty")
        .when(F.size(types) > 0, F.concat(F.lit("output_pii_detected:"), F.array_join(types, ",")))
        .when(any_match(clean, LEAKAGE_PATTERNS) | is_injection(clean), "output_prompt_or_instruction_leakage")
        .when(any_match(clean, CERTAINTY_PATTERNS), "unsupported_financial_or_legal_certainty")
    )
    return _verdict(reason, clean)


def safe_reply(text: Column) -> Column:
    """The reply itself, or the standard text when it is withheld."""
    return F.when(output_verdict(text)["allowed"], text).otherwise(F.lit(WITHHELD_REPLY))


def screen_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per screened text field of each record, with verdict and message."""
    fields = [c for c in df.columns if c in TEXT_FIELDS]
    if not fields:
        raise ValueError(f"no text field among {TEXT_FIELDS}")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields
    ]))
    rows = df.select(*keys, pairs.alias("_f")).where(F.col("_f.value").isNotNull())
    judged = rows.withColumn("_v", input_verdict(F.col("_f.value")))
    reason = F.split_part(F.col("_v.reason"), F.lit(":"), F.lit(1))
    messages = F.create_map(*[F.lit(x) for pair in REFUSAL_MESSAGES.items() for x in pair])
    message = F.when(~F.col("_v.allowed"), F.coalesce(F.try_element_at(messages, reason), F.lit(OTHER_REFUSAL)))
    return judged.select(*keys, "_f.field", "_v.allowed", "_v.reason", message.alias("message"))


def request_violations(cep: Column, area: Column, ano: Column, mes: Column, ano_mes: Column | None = None) -> Column:
    """Names of the numeric rules a prediction request breaks."""
    digits = F.regexp_replace(F.coalesce(cep.cast("string"), F.lit("")), "[^0-9]", "")
    checks = [
        ("cep_invalido", digits == ""),
        ("area_invalida", F.coalesce(area <= 0, F.lit(True))),
        ("ano_invalido", ~F.coalesce(ano.between(1900, 2999), F.lit(True))),
        ("mes_invalido", ~F.coalesce(mes.between(1, 12), F.lit(True))),
    ]
    period_known = ano.isNotNull() & mes.isNotNull()
    if ano_mes is not None:
        bad = ~ano_mes.between(190001, 299912) | ~(ano_mes % 100).between(1, 12)
        checks.append(("ano_mes_invalido", F.coalesce(bad, F.lit(False))))
        period_known = period_known | ano_mes.isNotNull()
    checks.append(("periodo_ausente", ~period_known))
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))


def _mentions(message: Column, keywords: Sequence[str]) -> Column:
    lowered = F.lower(message)
    return F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(lowered, k))


def route(message: Column, has_property_data: Column) -> Column:
    """Tool for a message: price with property data, direct search, then by intent.

    ``undecided`` means the keywords settle nothing.
    """
    return (
        F.when(has_property_data & _mentions(message, PRICE_KEYWORDS), "price_estimator")
        .when(~_mentions(message, TOOL_KEYWORDS), "rag_search")
        .otherwise(intent(message))
    )


def intent(message: Column) -> Column:
    """Tool by keywords alone."""
    return (
        F.when(_mentions(message, COMPARE_KEYWORDS), "region_comparer")
        .when(_mentions(message, PRICE_KEYWORDS), "price_estimator")
        .when(_mentions(message, SEARCH_KEYWORDS), "rag_search")
        .otherwise("undecided")
    )


def fallback_route(message: Column) -> Column:
    """Tool when the deciding model failed."""
    return (
        F.when(_mentions(message, FALLBACK_PRICE_KEYWORDS), "price_estimator")
        .when(_mentions(message, COMPARE_KEYWORDS), "region_comparer")
        .otherwise("rag_search")
    )


def error_class(error: Column) -> Column:
    """``llm_provider_error`` for provider-like messages, else ``internal_error``; NULL without error."""
    lowered = F.lower(error)
    provider = F.exists(F.array(*[F.lit(m) for m in PROVIDER_MARKERS]), lambda m: F.contains(lowered, m))
    return F.when(error.isNotNull(), F.when(provider, "llm_provider_error").otherwise("internal_error"))
