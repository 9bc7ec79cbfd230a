"""Headlines and news candidates: policy classes, context, review points, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, mask_names, person_name, policy_key
from .dedupe import keep_first

# Word beginnings and phrases by which a headline is restricted.
ADVERSE_STEMS = (
    "absolv", "abus", "archiv", "arrest", "acus", "caso", "conden", "culp", "delit", "demand", "denunci", "deten", "estafa", "fallec", "fallo", "fiscal", "formaliz", "homicid", "indemn", "inhabil",
    "imput", "investig", "juicio", "lesion", "mato", "muerte", "muri", "neglig", "procesad", "prision", "querell", "responsab", "sancion", "sentenc", "sobrese", "sumari", "suspend", "tribunal",
)
ADVERSE_PHRASES = ("mala praxis", "error medico", "juicio penal")
MINOR_STEMS = ("adolesc", "bebe", "menor", "nina", "nino", "pediatr")
MINOR_PHRASES = ("recien nacido", "recien nacida")
HEALTH_STEMS = (
    "abort", "atendi", "cancer", "cirugi", "consult", "diagnostic", "dialisis", "enfermed", "embaraz", "fertil", "gasa", "hospitaliz", "infect", "internad", "medicacion", "medicament", "mutualista", "oncolog",
    "operacion", "operad", "opero", "paciente", "padec", "parto", "procedimiento", "reproduccion", "sanatorio", "sida", "sintom", "terapia", "trat", "transplant", "tratamiento", "tumor", "vih", "sufr",
)
HEALTH_PHRASES = ("clinica privada", "estado de salud", "historia clinica", "salud mental")
# Words that corroborate nothing, and beginnings that name a specialty.
GENERIC_CONTEXT = (
    "ASOCIACION", "CENTRO", "CLINICA", "DE", "DEL", "DOCTOR", "DOCTORA", "EN", "ESPECIALISTA", "GENERAL", "HOSPITAL", "INSTITUCION", "MEDICA", "MEDICO", "MEDICINA", "MUTUALISTA", "SANATORIO", "SERVICIO",
    "SOCIEDAD", "Y",
)
SPECIALTY_STEMS = (
    "ANESTES", "CARDIOL", "CIRU", "DERMATOL", "ENDOCRINOL", "GASTROENTEROL", "GERIATR", "GINECOL", "HEMATOL", "INFECTOL", "NEFROL", "NEUMOL", "NEUROL", "OFTALMOL", "ONCOL", "OTORRINOLARINGOL", "PSIQUIATR",
    "REUMATOL", "TRAUMATOL", "UROL",
)
# Roles, and the closed forms that a whole masked headline may have to be clearly benign.
ROLE = (
    "(?:anestesiolog[oa]|anestesista|cardiolog[oa]|cirujan[oa]|dermatolog[oa]|endocrinolog[oa]|fisiatra|gastroenterolog[oa]|geriatra|ginecolog[oa]|hematolog[oa]|infectolog[oa]|internista|nefrolog[oa]|neumolog[oa]"
    "|neurolog[oa]|oftalmolog[oa]|oncolog[oa]|otorrinolaringolog[oa]|psiquiatra|reumatolog[oa]|traumatolog[oa]|urolog[oa])"
)
BENIGN = (
    "(?:recibio|recibieron|obtuvo|obtuvieron|gano|ganaron) (?:un|el) (?:premio|reconocimiento)(?: (?:academico|academica|cientifico|cientifica|institucional|nacional|internacional))?",
    "(?:asumio|asumieron) (?:un|el) cargo (?:academico|academica|docente|institucional)",
    "(?:presento|presentaron) (?:un|el) proyecto (?:academico|academica|cientifico|cientifica|universitario|universitaria|institucional)(?: vigente)?",
    "(?:participo|participaron) en (?:un|el) (?:congreso|seminario|evento academico|evento cientifico|jornada academica|jornada cientifica)",
    "(?:fue|fueron) (?:designado|designada|designados|designadas|nombrado|nombrada|nombrados|nombradas|reconocido|reconocida|reconocidos|reconocidas) (?:en|para) (?:un|el) cargo (?:academico|academica|docente|institucional)",
)
NOT_BENIGN = "NOT_CLEARLY_BENIGN_PUBLIC_CONTEXT"
CEILING = 49
FAN_OUT_CAP = 25
CLASSES = (("ADVERSE_OR_JUDICIAL", ADVERSE_STEMS, ADVERSE_PHRASES), ("MINOR", MINOR_STEMS, MINOR_PHRASES), ("PRIVATE_HEALTH", HEALTH_STEMS, HEALTH_PHRASES))


def sensitive_classes(key: Column, classes=CLASSES) -> Column:
    """Array of the classes that a normalised headline falls in, in order."""
    tokens, padded = F.split(key, " "), F.concat(F.lit(" "), key, F.lit(" "))

    def hit(stems: tuple, phrases: tuple) -> Column:
        by_stem = F.exists(tokens, lambda t: t.rlike("^(" + "|".join(stems) + ")"))
        for p in phrases:
            by_stem = by_stem | F.contains(padded, F.lit(f" {p} "))
        return by_stem

    return F.filter(F.array(*[F.when(hit(s, p), F.lit(n)) for n, s, p in classes]), lambda x: x.isNotNull())


def closed_benign(key: Column, names: Column) -> Column:
    """Whether a normalised headline, its names masked, has one of the closed forms as a whole, with as many masks as names."""
    one = rf"(?:(?:el|la) )?(?:(?:dr|dra|doctor|doctora|{ROLE}) )?professional"
    subject = rf"{one}(?: y {one}){{0,3}}"
    count = lambda masked: F.size(F.filter(F.split(masked, " "), lambda w: w == "professional"))
    whole = lambda n: lambda masked: (F.size(n) > 0) & (count(masked) == F.size(n)) & masked.rlike(f"^{subject} (?:" + "|".join(BENIGN) + ")$")
    return let(names, lambda n: let(mask_names(key, n), whole(n)))


def headline_reasons(headline: Column, names: Column, classes=CLASSES) -> Column:
    """Why a headline is restricted, in order; none only for a closed benign form around the names found in it. ``names`` are
    the mentions as they stand."""
    lower = F.transform(names, lambda n: F.lower(person_name(n)))
    judged = lambda key: lambda found: F.when((F.size(found) > 0) | closed_benign(key, lower), found).otherwise(F.array(F.lit(NOT_BENIGN)))
    return let(policy_key(headline), lambda key: let(sensitive_classes(key, classes), judged(key)))


def context_token_match(a: Column, b: Column) -> Column:
    """Equal words, one specialty stem at the start of both, or six equal first letters of two words that have so many."""
    same = (a == b) | ((F.char_length(a) >= 6) & (F.char_length(b) >= 6) & (F.left(a, F.lit(6)) == F.left(b, F.lit(6))))
    for s in SPECIALTY_STEMS:
        same = same | (F.startswith(a, F.lit(s)) & F.startswith(b, F.lit(s)))
    return same


def context_words(words: Column) -> Column:
    """Words that can corroborate: three letters or more, none of the generic ones."""
    return F.filter(words, lambda t: (F.char_length(t) >= 3) & ~t.isin(*GENERIC_CONTEXT))


def context_match(context: Column, observed: Column) -> Column:
    """Whether a meaningful word of a context matches any word observed."""
    return F.exists(context_words(context), lambda x: F.exists(observed, lambda y: context_token_match(x, y)))


def context_keys(words: Column) -> Column:
    """Keys of an array of words: two words share one exactly if ``context_token_match`` holds. First six letters stand for
    a whole shorter word, for six common letters and for stems of six or more; shorter stems have keys of their own."""
    six = F.array_distinct(F.transform(words, lambda w: F.left(w, F.lit(6))))
    begins = lambda s: F.exists(six, lambda w: F.startswith(w, F.lit(s)))
    stems = F.array(*[F.when(begins(s), F.lit(f"{s}-")) for s in SPECIALTY_STEMS if len(s) < 6])
    return F.concat(six, F.filter(stems, lambda k: k.isNotNull()))


def context_pairs(observed: DataFrame, contexts: DataFrame, observed_id: str, context_id: str) -> DataFrame:
    """Rows (id, words) on both sides -> pairs for which ``context_match`` holds, with how many distinct words of the
    context match. Where ``observed`` is partitioned by its id and contexts are small, nothing of it is shuffled."""
    meant = contexts.select(context_id, F.explode(context_words(F.col("words"))).alias("_t")).distinct()
    keyed = meant.select("_t").distinct().select("_t", F.explode(context_keys(F.array("_t"))).alias("_k"))
    said = observed.select(observed_id, F.explode(context_keys(F.col("words"))).alias("_k"))
    hits = said.join(keyed, "_k").select(observed_id, "_t").distinct()
    return hits.join(meant, "_t").groupBy(observed_id, context_id).agg(F.count(F.lit(1)).alias("shared"))


def review_points(kind: Column, coverage: Column, ambiguous: Column, medical: Column, corroborated: Column) -> Column:
    """Priority for human review, 1 to 49: never a probability."""
    less = lambda c, n: F.when(c, n).otherwise(0)
    exact = F.when(ambiguous, 30).otherwise(CEILING) - less(~medical, 10) + less(corroborated, 5)
    partial = F.floor(20 + coverage * 20 + less(corroborated, 10) - less(ambiguous, 10) - less(~medical, 10) + 0.5)
    initials = 10 + less(medical, 5) + less(corroborated, 15) - less(ambiguous, 10)
    raw = F.when(kind == "EXACT_NORMALIZED_NAME", exact).when(kind == "PARTIAL_TOKEN_SUBSET", partial).otherwise(initials)
    return F.greatest(F.lit(1), F.least(F.lit(CEILING), raw)).cast("int")


def alert_severity(kind: Column, ambiguous: Column, corroborated: Column) -> Column:
    """How strongly a reviewer must be warned of a false link."""
    partial = kind == "PARTIAL_TOKEN_SUBSET"
    return F.when((kind == "INITIALS_TOKEN_SUBSEQUENCE") | ambiguous | (partial & ~corroborated), "CRITICAL").when(partial, "HIGH").otherwise("WARNING")


# Alert codes.
def alert_codes(kind: Column, ambiguous: Column, corroborated: Column) -> Column:
    """Codes of a match's alert, in order."""
    flexible, initials = kind != "EXACT_NORMALIZED_NAME", kind == "INITIALS_TOKEN_SUBSEQUENCE"
    codes = [F.lit("POSSIBLE_IDENTITY_MATCH_NOT_CONFIRMED"), F.lit("HUMAN_REVIEW_REQUIRED"), F.lit("NAME_MATCH_IS_NOT_IDENTITY_PROOF")]
    codes += [F.when(flexible, "FLEXIBLE_MATCH_HIGH_FALSE_POSITIVE_RISK"), F.when(initials, "INITIALS_MATCH_VERY_HIGH_FALSE_POSITIVE_RISK")]
    codes += [F.when(corroborated, "CONTEXTUAL_SIGNAL_IS_NOT_IDENTITY_PROOF").otherwise("NO_CONTEXTUAL_CORROBORATION"), F.when(ambiguous, "MULTIPLE_POSSIBLE_IDENTITIES")]
    return F.filter(F.array(*codes), lambda x: x.isNotNull())


def strongest(candidates: DataFrame, key: list[str]) -> DataFrame:
    """The best candidate of each key (a professional and an article): least flexibility, then most context dimensions, most
    points, first mention. Columns: flexibility, n_context, points, mention."""
    return keep_first(candidates, key, ["flexibility", F.col("n_context").desc(), F.col("points").desc(), "mention"])


def candidate_counters(candidates: DataFrame, articles: DataFrame) -> DataFrame:
    """One row of counters. candidates: article_id, kind, n_context, severity, ambiguity; articles: article_id, n_names. Both are
    aggregated on their own, so an article without candidates counts too."""
    kind = lambda k: F.count_if(F.col("kind") == k)
    c = candidates.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_distinct("article_id").alias("articles_with_candidates"), kind("EXACT_NORMALIZED_NAME").alias("exact_candidates"), kind("PARTIAL_TOKEN_SUBSET").alias("partial_candidates"),
        kind("INITIALS_TOKEN_SUBSEQUENCE").alias("initials_candidates"), F.count_if(F.col("n_context") > 0).alias("context_corroborated"), F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts"),
        F.count_if(F.col("ambiguity") == "HOMONYM").alias("homonym_candidates"), F.count_if(F.col("ambiguity") != "NONE").alias("ambiguous_candidates"),
    )
    a = articles.agg(F.count(F.lit(1)).alias("articles"), F.coalesce(F.sum("n_names"), F.lit(0)).alias("mentions"))
    return c.crossJoin(a).withColumn("articles_without_candidates", F.col("articles") - F.col("articles_with_candidates"))  # one row each


# Reason codes.
def match_reasons(kind: Column, homonym: Column, several: Column, medical: Column, profession: Column, institution: Column) -> Column:
    """Reason codes in fixed order; the last always says that no second identifier exists."""
    context = profession | institution
    codes = [
        kind, F.when(homonym, "HOMONYM_NORMALIZED_NAME").when(several, "MULTIPLE_PROFESSIONALS_MATCH_MENTION"), F.when(medical, "MEDICAL_CONTEXT_PRESENT").otherwise("NO_MEDICAL_CONTEXT"),
        F.when(profession, "PROFESSION_CONTEXT_MATCH"), F.when(institution, "INSTITUTION_CONTEXT_MATCH"), F.when(context, "CONTEXTUAL_SIGNAL_NOT_IDENTITY_PROOF"),
        F.when(~context, "NAME_ONLY_NO_IDENTITY_PROOF"), F.when(~context, "NO_CONTEXTUAL_CORROBORATION"), F.when(kind != "EXACT_NORMALIZED_NAME", "FLEXIBLE_NAME_MATCH_REQUIRES_ENHANCED_REVIEW"), F.lit("NO_SECONDARY_IDENTIFIER"),
    ]
    return F.filter(F.array(*codes), lambda x: x.isNotNull())


# What a reviewer is told.
SAID = {"EXACT_NORMALIZED_NAME": "nombre completo normalizado", "PARTIAL_TOKEN_SUBSET": "nombre parcial", "INITIALS_TOKEN_SUBSEQUENCE": "iniciales y nombre parcial"}
MESSAGE = ("Posible coincidencia por ", ". La identidad no está confirmada; no atribuir el artículo, sus hechos ni conclusiones al profesional sin revisión humana y evidencia secundaria verificable.")
MEDICAL = "El titular contiene una señal léxica de contexto médico, que no acredita identidad."
NOT_MEDICAL = "El titular no contiene una señal léxica de contexto médico, por lo que la prioridad de revisión se reduce."
CORROBORATED = ("Hay coincidencia contextual de ", ", pero es sólo una señal de apoyo y tampoco acredita identidad.")
NOT_CORROBORATED = "No se encontró corroboración contextual por profesión o institución; la ausencia de esos datos no se interpreta como contradicción."
HOMONYM = "El nombre normalizado coincide exactamente con más de un profesional. Es una hipótesis ambigua y no acredita identidad."
SEVERAL = "La mención flexible es compatible con varios profesionales. Es una hipótesis ambigua y no acredita identidad."
EXACT = "El nombre normalizado coincide exactamente, pero no acredita identidad ni confirma hechos del artículo."
PARTIAL = "La mención contiene un subconjunto de al menos dos tokens del nombre. Tiene riesgo elevado de falso positivo y requiere identificadores secundarios y revisión humana."
INITIALS = "La mención combina una o más iniciales con al menos un token completo del nombre, en el mismo orden. Tiene riesgo muy alto de falso positivo y requiere identificadores secundarios y revisión humana reforzada."


def alert_message(kind: Column) -> Column:
    how = F.create_map(*[F.lit(x) for pair in SAID.items() for x in pair])[kind]
    return F.concat(F.lit(MESSAGE[0]), how, F.lit(MESSAGE[1]))


def explanation(kind: Column, homonym: Column, several: Column, medical: Column, profession: Column, institution: Column) -> Column:
    """What the match rests on: the kind or its ambiguity, then the corroboration, then the context."""
    which = F.concat_ws(" e ", F.when(profession, "profesión"), F.when(institution, "institución"))
    support = F.when(profession | institution, F.concat(F.lit(CORROBORATED[0]), which, F.lit(CORROBORATED[1]))).otherwise(NOT_CORROBORATED)
    lead = F.when(homonym, HOMONYM).when(several, SEVERAL).when(kind == "EXACT_NORMALIZED_NAME", EXACT).when(kind == "PARTIAL_TOKEN_SUBSET", PARTIAL).otherwise(INITIALS)
    return F.concat_ws(" ", lead, support, F.when(medical, MEDICAL).otherwise(NOT_MEDICAL))


def source_counters(items: DataFrame, source: str, as_of: Column, stale_hours: int = 72, days: int = 30) -> DataFrame:
    """Per source the counts of its items and the histogram of why some were restricted. items: published, reasons (array, empty
    if not restricted), seen (restricted earlier under its address), n_names. An item published after ``as_of`` is invalid,
    one before the window stale; where the newest is too old the source is STALE and all its items are skipped. One item adds
    to several reasons, one restricted earlier to none."""
    kind = window_class(F.col("published"), as_of, days)
    newest = F.max(F.when(kind != "future", F.col("published")))
    valid = kind == "valid"
    restricted = valid & ((F.size("reasons") > 0) | F.col("seen"))
    fresh = valid & ~restricted
    names = sorted({*(n for n, _, _ in CLASSES), NOT_BENIGN})
    why = [F.count_if(valid & F.array_contains("reasons", n)).alias(f"restricted_{n.lower()}") for n in names]
    out = items.groupBy(source).agg(
        F.count(F.lit(1)).alias("discovered"), F.count_if(kind == "future").alias("invalid"), F.count_if(kind == "stale").alias("skipped_stale"), F.count_if(restricted).alias("restricted"), F.count_if(fresh & (F.col("n_names") > 0)).alias("with_mentions"),
        F.count_if(fresh & (F.col("n_names") == 0)).alias("without_mentions"), newest.alias("freshest"), *why,
    )
    stale = F.coalesce(F.col("freshest") < as_of - F.make_dt_interval(F.lit(0), F.lit(stale_hours)), F.lit(True))
    counters = ["restricted", "with_mentions", "without_mentions", *[f"restricted_{n.lower()}" for n in names]]
    out = out.withColumn("status", F.when(stale, "STALE").otherwise("FETCHED"))
    skipped = F.when(stale, F.col("discovered") - F.col("invalid")).otherwise(F.col("skipped_stale"))
    return out.withColumns({"skipped_stale": skipped, **{c: F.when(stale, F.lit(0)).otherwise(F.col(c)).cast("long") for c in counters}})


def window_class(published: Column, retrieved: Column, days: int = 30) -> Column:
    """future: after retrieval; stale: older than the collection window; else valid. Equal instants are valid."""
    return F.when(published > retrieved, "future").when(published < retrieved - F.make_dt_interval(F.lit(days)), "stale").otherwise("valid")
