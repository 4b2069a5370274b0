"""Parameters and fixed values of the review-insight jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# These must equal the values existing users rely on; they are data, not logic.

TOPICS = {
    "food": "food taste flavor menu dishes portion fresh spicy presentation",
    "service": "service staff wait time hostess server rude friendly attentive",
    "ambiance": "ambiance atmosphere decor music lighting seating noise vibe",
}

CHAR_REPLACEMENTS = {
    "\u00a0": " ",
    "\u002b": "",
    "\x0b": " ",
    "“": '"',
    "’": "'",
}

HISTOGRAM_EDGES = (0, 5, 10, 20, 50, 80, 100)
HISTOGRAM_LABELS = ("0-5", "6-10", "11-20", "21-50", "51-80", "81-100", "100+")

# Placeholders: @NAME@ restaurant name, @TOPIC@ upper-case topic, @topic@ topic.
PROMPT_HEADER = """
                You are analyzing and synthesizing customer reviews for a restaurant called @NAME@, where the main topic is:
                
                Topic: @TOPIC@

                Using only the reviews included here, provide a concise (2-3 sentence) summary of @NAME@'s performance in the area of @topic@.

                Guidelines:
                - Capture common themes, impressions, and disagreements
                - Be factual and grounded in the evidence; do not invent details not supported by the excerpts
                - Begin by characterizing the group of reviews as "positive", "negative", or "mixed" 

                Output to avoid:
                - Content unrelated to the topic (for example: "noise levels" are ambiance, not food)
                - Review indicies (for example, "review 3"); those are not user-fsacing
                - Announcing the summary ("here is a concise summary..."); just start with summary content
                - Use of generic filler adjectives (e.g., cozy, delicious, amazing) unless the excerpts explicitly support them

                Important: if the excerpts don’t describe a topic clearly, say ‘<topic> details are limited in the provided reviews.’”

                """

# Placeholders: @I@ excerpt position from 0, @STARS@ star rating, @CHUNK@ text.
PROMPT_EXCERPT = """
                    [@I@] Review (@STARS@ stars):
                    @CHUNK@
                    """

LIMITED_DETAILS = "@topic@ details are limited in the provided reviews."
MISSING_SUMMARY = "No @topic@ summary available."
SUFFIXES = ("_reviews", "_restaurant")
# ----------------------------------------------------------------------------

# Every character that counts as white space in Unicode-aware text handling.
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


@dataclass(frozen=True)
class Params:
    """Settings of one run; every operator also takes them as keywords."""

    # ingest and selection
    head_rows: int | None = None  # only the first N lines of each input
    null_policy: str = "any"  # "any" column or only the "required" ones
    min_reviews: int = 100  # strictly more distinct reviews than this
    n_entities: int | None = 10  # None: all eligible ones
    seed: int | None = 1  # None draws a seed
    strict_sample: bool = True  # fail when fewer entities qualify
    include: str = "restaurant"
    exclude: str = "hotel|cinema"

    # column names of the joined input
    col_category: str = "categories"
    col_entity: str = "business_id"
    col_name: str = "name"
    col_review: str = "review_id"
    col_stars: str = "stars_reviews"
    col_date: str = "date"
    col_text: str = "text"
    col_order: str = "ordinal"  # file order; without it the review id decides

    # cleaning and chunking
    min_chars: int = 30
    chunk_size: int = 1000
    overlap: int = 200
    min_chunk: int = 230
    chunk_mode: str = "sliding"  # or "first"

    # vectors and retrieval
    batch_size: int = 64
    normalize: bool = True
    metric: str = "ip"  # "ip", "cosine" or "l2"
    top_k: int = 25
    max_per_review: int = 1
    max_per_topic: int = 12
    vector_buckets: int = 64  # folders of the vector table
    topics: dict[str, str] = field(default_factory=lambda: dict(TOPICS))
