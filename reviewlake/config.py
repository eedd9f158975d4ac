"""Settings of the review engine, overridable by environment, and its language packs."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class LanguagePack:
    """Words that drive clause splitting, keywords and the lexicon classifier of one language."""

    connectives: dict[str, tuple[str, ...]]
    enumeration: str | None
    token: str
    keyword: str
    stopwords: tuple[str, ...]
    positive: tuple[str, ...]
    negative: tuple[str, ...]
    #: Whether a word counts by its stem, as in languages that inflect by endings, or only as a whole.
    stems: bool = False


# The Korean words and patterns that results must agree on.
KOREAN = LanguagePack(
    connectives={
        "contrast": ("그럼에도 불구하고", "에도 불구하고", "인데도 불구하고", "그렇긴 하지만", "그렇긴 한데", "기는 하지만", "긴 하지만", "긴 한데", "그렇지만", "하지만", "그러나", "다만", "반면에", "반대로", "오히려"),
        "turn": ("그런데", "한편"),
        "additive": ("그리고", "또한", "게다가", "더불어", "나아가", "뿐만 아니라"),
        "cause": ("그래서", "그러므로", "따라서", "그러니까", "그러니", "때문에", "덕분에"),
        "conditional": ("만약", "만일", "만약에", "만일에", "이라면", "라면", "다면"),
    },
    enumeration=r"도\s*[^\s]{1,8}\s*고\s*",
    token="[가-힣A-Za-z]{2,}",
    keyword="[가-힣]{2,}",
    stopwords=("은", "는", "이", "가", "을", "를", "에", "도", "너무", "정말", "그냥"),
    positive=("좋", "맛있", "신선", "만족", "추천", "최고"),
    negative=("나쁘", "별로", "상했", "실망", "최악", "썩"),
    stems=True,
)

EUROPEAN = LanguagePack(
    connectives={
        "contrast": (" with ", " mit ", " avec ", " con "),
        "turn": (" at ", " bei "),
        "additive": (" and ", " und ", " et ", " y "),
        "cause": (" for ", " that ", " que ", " dass "),
        "conditional": (" if ", " wenn "),
    },
    enumeration=None,
    token="[A-Za-z]{2,}",
    keyword="[a-z]{4,}",
    stopwords=("that", "with", "from", "this"),
    positive=("good", "great", "excellent", "fresh", "tasty", "love", "gut", "toll", "lecker", "bon", "bien", "bueno", "rico"),
    negative=("bad", "poor", "awful", "rotten", "late", "broken", "schlecht", "faul", "mauvais", "malo", "podrido"),
)

LANGUAGES = {"korean": KOREAN, "european": EUROPEAN}


# The numbers that results must agree on.
@dataclass(frozen=True)
class Settings:
    confidence: float = 0.6
    split_jaccard_add: float = 0.35
    split_jaccard_contrast: float = 0.40
    split_distance: float = 0.22
    split_min_length: int = 4
    split_max: int = 3
    split_embedding: bool = True
    top_representatives: int = 3
    merge_threshold: float = 0.93
    merge_percentile: float | None = None
    top_keywords: int = 3
    facet_top_k: int = 2
    facet_threshold: float = 0.32
    hetero_threshold: float = 0.16
    min_split_size: int = 35
    max_local_k: int = 4
    community_rel_tau: float = 0.40
    community_alias_tau: float = 0.40
    community_ban_mode: str = "strict"
    community_summary_max: int = 10
    alias_query_cap: int = 32
    facet_query_cap: int = 64
    selection_epsilon: float = 0.05
    embedding_dims: int = 64
    embedding_model: str = "md5-hashing"
    keyword_docs: int = 50
    seed: int = 42
    language: LanguagePack = field(default=KOREAN, repr=False)

    @classmethod
    def from_env(cls, **given) -> Settings:
        """COMMUNITY_* variables override the fields of the same name in lower case."""
        out = {}
        for f in fields(cls):
            raw = os.environ.get(f.name.upper()) if f.name.startswith("community_") else None
            if raw is not None:
                out[f.name] = type(f.default)(raw)
        return replace(cls(), **(out | given))


# Offsets and order of the polarities, and the label of noise.
POLARITIES = ("negative", "neutral", "positive")
BASES = {"negative": 0, "neutral": 1000, "positive": 2000}
NOISE = -1
NOISE_OFFSET = 999
