"""Prompt templates and prompt building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instructions, word for word.
TEXT_PROMPT = (
    "I am going to give you a chunk of text. Please identify {what} used in the text. "
    "Do not tell me anything besides {what} If you tell me anything besides {what} "
    "you will not be helptful. The text is:"
)
SINGLE_MODEL_PROMPT = (
    "I am going to give you a chunk of text. Please identify {what} used in the text. "
    "Do not tell me anything else. If you tell me anything besides {what} used in the text "
    "you will not be helpful. The text is:"
)
IMAGE_PROMPT = (
    "You are a design expert in a design review. You will be shown an image. "
    "Please tell me {what} concisely and only return {what}. "
    "If multiple items are present, separate them with commas. "
    "if you tell me anything other than {what}, you will not be helpful."
)
ABSTRACT_PROMPTS = {
    "results": (
        "I am going to give you the text of an abstract. Please identify the results from the abstract. "
        "Do not tell me anything else. If you tell me anything besides the results used in the abstract "
        "you will not be helpful. The abstract text is:"
    ),
    "methods": (
        "I am going to give you the text of an abstract. Please identify the methods used in the abstract. "
        "Do not tell me anything else. If you tell me anything besides the methods used in the abstract "
        "you will not be helpful. The abstract text is:"
    ),
    "location": (
        "I am going to give you the text of an abstract. Please tell me what where the research was conducted. "
        "Do not tell me anything else. If you tell me anything besides where the research was conducted "
        "you will not be helpful. If no location is mentioned, say none. The abstract text is:"
    ),
    "theory": (
        "I am going to give you the text of an abstract. Please tell me what planning theory was used in the abstract. "
        "Do not tell me anything else. If you tell me anything besides the urban planning theory used in the abstract "
        "you will not be helpful. If no urban planning theory was used say none. The abstract text is:"
    ),
    "n_themes": (
        "I am going to give you the text of an abstract. Please identify three themes from the abstract. "
        "Do not tell me anything else. If you tell me anything besides the three themes used in the abstract "
        "you will not be helpful. The abstract text is:"
    ),
}


def text_prompt(what: str = "the main topic") -> str:
    return TEXT_PROMPT.format(what=what)


def image_prompt(what: str = "objects") -> str:
    return IMAGE_PROMPT.format(what=what)


def single_model_prompt(what: str) -> str:
    return SINGLE_MODEL_PROMPT.format(what=what)


def library(what_text: str = "the main topic", what_image: str = "objects") -> dict[str, str]:
    """All templates by name, free slots filled."""
    return {"text": text_prompt(what_text), "image": image_prompt(what_image), **ABSTRACT_PROMPTS}


def build_prompt(template: str, content: Column) -> Column:
    """Instruction, one space, content; null content gives a null prompt."""
    return F.concat(F.lit(template + " "), content.cast("string"))
