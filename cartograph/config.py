"""Run options and the fixed values the results depend on."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Any

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match the
# discovery semantics this library reproduces (name patterns, weights,
# thresholds, texts). Listed in their natural order.
# ---------------------------------------------------------------------------

# Column-name patterns for the rule-based semantic type, tried in this order
# after the e-mail test; each is matched as \b(...)\b, ignoring case.
PATTERN_ID = "id|key|code|pk|uuid|guid"
PATTERN_DATE = "date|time|ts|created|updated|modified|at"
PATTERN_AMOUNT = "amount|price|cost|revenue|salary|fee|total|balance"
PATTERN_NAME = "name|label|title|desc|description"
PATTERN_FLAG = "flag|is_|has_|active|enabled|deleted"
PATTERN_GEO = "country|city|state|region|zip|postal|lat|lon|geo"
PATTERN_EMAIL = r"^[^@]+@[^@]+\.[^@]+$"

# Relationship scoring.
WEIGHT_OVERLAP = 0.60
WEIGHT_NAME = 0.20
WEIGHT_CARDINALITY = 0.20
MIN_OVERLAP = 0.05
FIT_PK_UNIQUE = 0.5
FIT_PK_NO_NULLS = 0.25
FIT_FK_NOT_UNIQUE = 0.25
RELATIONSHIP_TYPE = "FK → PK (candidate)"

# Tiers.
AUTO_ACCEPT = 0.85
HUMAN_REVIEW = 0.50
FK_EXCLUDED_TYPES = ("monetary_amount", "boolean_flag", "datetime", "numeric")

# Profiling defaults.
SAMPLE_VALUES = 10
SAMPLE_SEED = 42

# Semantic phase.
PROMPT_SAMPLES = 5
DEFAULT_CONFIDENCE = 0.5
DEFAULT_SENSITIVITY = "low"
FALLBACK_DESCRIPTION = "Could not infer — LLM response parse failure."
FALLBACK_SENSITIVITY = "low"
FALLBACK_CONFIDENCE = 0.3
STUB_RESPONSE = (
    "STUB RESPONSE | provider=stub | prompt_chars={n} | "
    "Set llm_provider in pipeline_config.json to activate a real model."
)
SYSTEM_PROMPT = """
You are a senior data analyst specialising in undocumented datasets.
Given a table name, column names, data types, and sample values,
infer the business meaning of each column.

Respond ONLY with a valid JSON array — one object per column — in this format:
[
  {
    "column_name":    "<exact column name as given>",
    "business_label": "<short human-friendly name, 2-5 words>",
    "description":    "<1-2 sentences explaining business meaning>",
    "sensitivity":    "<one of: low | medium | high | pii>",
    "confidence":     <float between 0.0 and 1.0>
  },
  ...
]

Rules:
- Output ONLY the JSON array. No markdown, no explanation, no preamble.
- sensitivity = "pii" for names, emails, phone numbers, IDs, addresses.
- sensitivity = "high" for financial amounts, account numbers.
- sensitivity = "medium" for operational codes, internal identifiers.
- sensitivity = "low" for timestamps, flags, generic counts.
- confidence = 1.0 means you are certain; 0.5 means you are guessing.
- If you cannot infer meaning, set description = "Unknown — insufficient context"
  and confidence = 0.3.
""".strip()

# Result table names.
TABLE_DISCOVERY = "discovery_results"
TABLE_PROFILING = "profiling_results"
TABLE_RELATIONSHIP = "relationship_candidates"
TABLE_SEMANTIC = "semantic_results"
TABLE_RUNS = "pipeline_runs"
TOP_ARTEFACT_ROWS = 20

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Options:
    """Keyword arguments of a discovery run (all optional)."""

    extensions: tuple[str, ...] = (".parquet", ".csv", ".json")
    granularity: str = "file"               # "file" | "directory"
    sample_rows: int | None = None          # None = profile every row
    sample_values: int = SAMPLE_VALUES
    max_cols_per_table: int | None = None   # opt-in: FK columns beyond are listed as left out
    min_overlap: float = MIN_OVERLAP
    auto_accept: float = AUTO_ACCEPT
    human_review: float = HUMAN_REVIEW
    fk_excluded_types: tuple[str, ...] = FK_EXCLUDED_TYPES
    name_match: str = "word"                # "word" (\b) | "token" (snake_case aware)
    edit: str = "difflib"                   # "difflib" | "levenshtein"
    provider: Any = "stub"                  # "stub" | "rules" | callable(pdf) -> pdf
    max_value_chars: int = 128              # longer values are grouped by prefix and digest
    raw_response_chars: int | None = None   # opt-in: cut stored replies
    spread_min_rows: int | None = None      # opt-in: spread under-split inputs of as many rows
    model_tasks: int | None = None          # tasks that call a model (default: the cores)
    model_timeout: float | None = 60.0      # seconds for one call of a model (None: no deadline)
    model_attempts: int = 1                 # calls for one table, at most
    model_wave: int = 8                     # calls of a task between two writes of finished replies
    lean_min_bytes: int = 256 << 20         # files from which unique columns are told apart before grouping
    datasets_per_plan: int = 200            # wide estates are profiled in batches
    output_schema: str = "cartograph_results"
    table_format: str = "parquet"
    artefacts_path: str | None = None       # default: <checkpoint dir>/artefacts
    jdbc_sources: tuple[dict, ...] = field(default_factory=tuple)
    tables: dict[str, str] = field(default_factory=lambda: {
        "discovery": TABLE_DISCOVERY,
        "profiling": TABLE_PROFILING,
        "relationship": TABLE_RELATIONSHIP,
        "semantic": TABLE_SEMANTIC,
    })

    def replace(self, **changes: Any) -> "Options":
        return dataclasses.replace(self, **changes)

    def snapshot(self, jdbc_sources: tuple = ()) -> dict[str, Any]:
        """Options for the run's record: of a connection only its name and
        which tables are asked for, never its address or credentials."""
        out = {f.name: getattr(self, f.name) for f in dataclasses.fields(self)}
        out["jdbc_sources"] = [{k: src[k] for k in ("name", "tables", "exclude_schemas") if k in src}
                               for src in (*jdbc_sources, *self.jdbc_sources)]
        out["provider"] = self.provider if isinstance(self.provider, str) else getattr(
            self.provider, "__name__", type(self.provider).__name__)
        return out


# Flagship options: integer keys may be foreign keys (numeric not excluded).
KEY_DISCOVERY = Options(fk_excluded_types=("monetary_amount", "boolean_flag", "datetime"))
