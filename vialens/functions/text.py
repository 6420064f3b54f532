"""String expressions: names, chunks, model replies."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialens.schemas import IMAGE_EXTENSIONS, SCENE_ATTRIBUTES

# Reply language instructions.
LANGUAGE_INSTRUCTIONS = {
    "English": "Response in English",
    "Chinese": "Response in Chinese",
    "Korean": "Response in Korean",
    "Japanese": "Response in Japanese",
}


def first_filled(a: Column, b: Column) -> Column:
    """``a`` unless it is NULL or empty, else ``b``."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def file_stem(name: Column) -> Column:
    """File name without its last extension; a leading dot is part of the stem."""
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+$", "")


def video_of(name: Column) -> Column:
    """Stem before its last dash; the whole stem when there is none."""
    return F.regexp_replace(file_stem(name), r"(?s)-[^-]*$", "")


def frame_of(name: Column) -> Column:
    """Stem after its last dash, as text; NULL when there is none."""
    stem = file_stem(name)
    return F.when(F.instr(stem, "-") > 0, F.substring_index(stem, "-", -1))


def is_image_name(name: Column) -> Column:
    return (F.instr(name, ".") > 0) & F.lower(F.substring_index(name, ".", -1)).isin(
        *IMAGE_EXTENSIONS
    )


def city_of(filename: Column) -> Column:
    return F.replace(filename, F.lit(" Brochure.pdf"), F.lit(""))


def text_slices(text: Column, size: int = 1500) -> Column:
    """Consecutive slices of ``size`` characters as an array; empty text gives none.

    One pass over the text: cutting with ``substring`` would walk it from the
    start again for every slice.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def language_instruction(language: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in LANGUAGE_INSTRUCTIONS.items() for x in kv])
    return F.coalesce(known[language], F.lit(LANGUAGE_INSTRUCTIONS["English"]))


def reply_json(reply: Column) -> Column:
    """The JSON part of a model reply.

    The body of the first ```json fence, else first ``{`` to last ``}``, else
    the reply itself. A fence that is never closed loses its last character.
    """
    opened = F.instr(reply, "```json")
    rest = F.substring(reply, opened + 7, F.length(reply))
    closed = F.instr(rest, "```")
    body = F.when(closed > 0, F.substring(rest, F.lit(1), closed - 1)).otherwise(
        F.substring(rest, F.lit(1), F.length(rest) - 1)
    )
    return (
        F.when(opened > 0, body)
        .when(
            F.contains(reply, F.lit("{")) & F.contains(reply, F.lit("}")),
            F.regexp_extract(reply, r"(?s)\{.*\}", 0),
        )
        .otherwise(reply)
    )


def reply_attributes(reply: Column) -> list[Column]:
    """weather, timeofday and scene read from a model reply; ``unknown`` when absent."""
    v = F.try_parse_json(reply_json(reply))
    inner = F.variant_get(v, "$.attributes", "variant")
    found = F.coalesce(inner, v)
    return [
        F.coalesce(F.try_variant_get(found, f"$.{a}", "string"), F.lit("unknown")).alias(a)
        for a in SCENE_ATTRIBUTES
    ]
