"""Questions from passages: prompts, an offline generator, and the parsing of answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V

FIELDS = {False: ("question", "answer"), True: ("question_turn_1", "answer_turn_1", "question_turn_2", "answer_turn_2")}

#: What a generator is asked for, by type; other types take the first.
HINTS = {
    "default": "Ask for one fact that the passage states.",
    "paraphrase_lookup": "Ask for a fact in other words than the passage uses.",
    "hallucination_test": "Ask for something that the passage does not say.",
    "multi_hop_within_corpus": "Ask for something that needs both excerpts.",
    "multi_hop_between_documents": "Ask for something that needs both excerpts.",
    "multi_turn_followup": "Ask a question and a second one that builds on its answer.",
}

#: Templates of the offline generator; one is chosen by a hash of the passage's key.
TEMPLATES = ("What does the text say about {}?", "Which passage mentions {}?", "Can you explain {}?", "Where is {} described?")


def prompt_messages(candidates: DataFrame) -> DataFrame:
    """(id, role, content): two messages for each candidate (id, type, passage, sources, difficulty).

    A column chapter is told with the sources; of temporal questions also dates (strings).
    """
    hint = F.lit(HINTS["default"])
    for name, said in HINTS.items():
        hint = F.when(F.col("type") == name, said).otherwise(hint)
    turns = F.col("type") == "multi_turn_followup"
    form = lambda multi: "{" + ", ".join(f'"{f}": "..."' for f in FIELDS[multi]) + "}"
    dates = F.when((F.col("type") == "temporal_questions") & (F.size("dates") > 0), F.concat(F.lit("Dates of the documents: "), F.array_join("dates", "; "))) if "dates" in candidates.columns else F.lit(None).cast("string")
    chapter = F.concat(F.lit("Chapter: "), "chapter") if "chapter" in candidates.columns else F.lit(None).cast("string")
    asked = F.concat_ws(
        "\n", F.concat(F.lit("Type: "), "type"), F.concat(F.lit("Difficulty: "), "difficulty"), F.concat(F.lit("Task: "), hint),
        F.concat(F.lit("Sources: "), F.array_join("sources", ", ")), chapter, dates, F.concat(F.lit("Passage:\n"), "passage"),
        F.concat(F.lit("Answer as JSON: "), F.when(turns, form(True)).otherwise(form(False))),
    )
    both = F.array(F.struct(F.lit("system").alias("role"), F.lit("You write test questions. Use the passage only.").alias("content")), F.struct(F.lit("user").alias("role"), asked.alias("content")))
    return candidates.select("id", F.explode(both).alias("m")).select("id", "m.role", "m.content")


def template_questions(candidates: DataFrame) -> DataFrame:
    """question and answer of each candidate (key, passage), by hash-seeded templates: no network, always the same."""
    draw = F.conv(F.substring(F.md5(F.col("key").cast("string").cast("binary")), 1, 7), 16, 10).cast("long")
    rows = candidates.withColumn("words", X.words(F.col("passage"))).withColumn("draw", draw)
    start = F.pmod(F.col("draw"), F.greatest(F.size("words") - 14, F.lit(1))).cast("int") + 1
    answer = F.array_join(F.slice("words", start, F.lit(15)), " ")
    topic = F.array_join(F.slice("words", start, F.lit(3)), " ")
    chosen = F.element_at(F.array(*(F.lit(t) for t in TEMPLATES)), (F.pmod(F.col("draw"), F.lit(len(TEMPLATES))) + 1).cast("int"))
    return rows.withColumn("question", F.replace(chosen, F.lit("{}"), topic)).withColumn("answer", answer).drop("words", "draw")


#: Wordings of the other offline generators: facts looked up under other words, facts joined, facts hidden in a passage, and what no text tells.
PARAPHRASES = ("Put in your own words: {}...", "What is known of this: {}...?", "Say more on: {}...", "Which details go with: {}...?")
NEEDLES = ("The blue key opens locker 17", "Ferry Aurora sails at noon", "Our lamp costs exactly 88 crowns", "Parcel seven went to Riga", "The old bridge has nine arches")
UNKNOWABLE = ("How warm is it on Neptune today?", "Who wins the chess title in 2071?", "What did the author dream last night?", "How many coins lay in the fountain in 1790?", "Which colour has the number eleven?")
NOT_FOUND = "The documents do not say."


def _draw(rows: DataFrame, n: int) -> Column:
    """A number below n from the hash of the row's key."""
    return F.pmod(F.conv(F.substring(F.md5(F.col("key").cast("string").cast("binary")), 1, 7), 16, 10).cast("long"), F.lit(n)).cast("int")


def _choice(rows: DataFrame, texts: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*(F.lit(t) for t in texts)), _draw(rows, len(texts)) + 1)


def paraphrase_questions(candidates: DataFrame) -> DataFrame:
    """As ``template_questions``, asked by the first 30 characters of the fact in other words."""
    rows = template_questions(candidates)
    return rows.withColumn("question", F.replace(_choice(rows, PARAPHRASES), F.lit("{}"), F.left("answer", F.lit(30))))


def joined_questions(candidates: DataFrame) -> DataFrame:
    """How the first eight words of each excerpt of a passage go together."""
    facts = F.transform(F.split("passage", V.SEPARATOR), lambda p: F.array_join(F.slice(X.words(p), 1, 8), " "))
    rows = candidates.withColumn("facts", facts)
    short = F.transform("facts", lambda f: F.concat(F.left(f, F.lit(30)), F.lit("...")))
    return rows.withColumn("question", F.concat(F.lit("How do these go together: "), F.array_join(short, " and "), F.lit("?"))).withColumn("answer", F.array_join("facts", "; ")).drop("facts")


def needle_questions(candidates: DataFrame) -> DataFrame:
    """A made-up fact is put behind the passage and asked for by its third word."""
    rows = candidates.withColumn("answer", _choice(candidates, NEEDLES))
    asked = F.concat(F.lit("What is said of "), F.get(F.split("answer", " "), F.lit(2)), F.lit("?"))
    return rows.withColumn("passage", F.concat_ws(" ", "passage", "answer")).withColumn("question", asked)


def unknowable_questions(candidates: DataFrame) -> DataFrame:
    """Questions that no document answers."""
    return candidates.withColumn("question", _choice(candidates, UNKNOWABLE)).withColumn("answer", F.lit(NOT_FOUND))


#: Generators by name: a function from candidates to candidates with question and answer.
GENERATORS: dict[str, Callable[[DataFrame], DataFrame]] = {"template": template_questions, "paraphrase": paraphrase_questions, "joined": joined_questions, "needle": needle_questions, "unknowable": unknowable_questions}


def register_generator(name: str, make: Callable[[DataFrame], DataFrame]) -> None:
    GENERATORS[name] = make


def generator(name: str) -> Callable[[DataFrame], DataFrame]:
    if name not in GENERATORS:
        raise ValueError(f"no generator of the name {name}; there are {sorted(GENERATORS)}")
    return GENERATORS[name]


def json_object(text: Column) -> Column:
    """The JSON object of an answer: the whole, or fenced, or the part between the outer braces; null else."""
    parse = lambda t: F.when(F.schema_of_variant(F.try_parse_json(t)).startswith("OBJECT"), F.try_parse_json(t))
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    return F.coalesce(parse(text), parse(fenced), parse(F.regexp_extract(text, r"(?s)\{.*\}", 0)))


def parsed_answers(answers: DataFrame, multi_turn: bool = False) -> DataFrame:
    """The fields of answers (row_id, raw); rows without all fields, or answered n/a, are left out."""
    rows = answers.withColumn("j", json_object(F.col("raw")))
    names = FIELDS[multi_turn]
    rows = rows.select("row_id", *(X.strip(F.try_variant_get("j", f"$.{f}", "string")).alias(f) for f in names))
    full = F.lit(True)
    for f in names:
        full = full & F.coalesce(F.length(f) > 0, F.lit(False))
        if f.startswith("answer"):
            full = full & F.coalesce(F.lower(f) != "n/a", F.lit(False))
    return rows.where(full)


def question_ids(questions: DataFrame, *order: Column | str) -> DataFrame:
    """id v2_{type}_{idx}, idx running over all accepted questions in the order; for the bounded result of a run."""
    return questions.withColumn("id", F.concat(F.lit("v2_"), "type", F.lit("_"), (F.row_number().over(Window.orderBy(*order)) - 1).cast("string")))
