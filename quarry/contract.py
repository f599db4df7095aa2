"""What the pipeline's parts agree on: closed lists, limits and switches."""

from __future__ import annotations

from dataclasses import dataclass

# Types, difficulties, labels, frequency tags and their other spellings.
TYPES = ("SINGLE", "MULTI", "JUDGE")
DIFFICULTIES = ("EASY", "MEDIUM", "HARD")
LABELS = ("A", "B", "C", "D", "E", "F")
SCORES = {"EASY": 1, "MEDIUM": 2, "HARD": 3}
FREQUENCIES = ("高频", "中频", "低频")
TYPE_NAMES = {
    "single": "SINGLE", "singlechoice": "SINGLE", "单选": "SINGLE", "单选题": "SINGLE",
    "multi": "MULTI", "multichoice": "MULTI", "多选": "MULTI", "多选题": "MULTI",
    "judge": "JUDGE", "truefalse": "JUDGE", "判断": "JUDGE", "判断题": "JUDGE", "对错": "JUDGE",
}
DIFFICULTY_NAMES = {
    "easy": "EASY", "简单": "EASY", "容易": "EASY",
    "medium": "MEDIUM", "中等": "MEDIUM", "中": "MEDIUM",
    "hard": "HARD", "困难": "HARD", "难": "HARD",
}
TRUE_WORDS = ("正确", "对", "是", "true", "t", "yes", "y")
FALSE_WORDS = ("错误", "错", "不对", "否", "false", "f", "no", "n")
QUESTION_WORDS = ("是什么", "什么是", "有哪些", "哪些", "为什么", "怎么", "怎样", "如何", "区别", "什么时候", "是否", "多少", "哪几种", "几种", "能否", "要不要")
SKIPPED_DIRS = ("json", ".qbgen", ".git", "node_modules", "__pycache__", ".venv", "dist", "build")
SKIPPED_FILES = ("tags.md",)
NO_CATEGORY = "未分类"
PUBLIC = ("type", "stem", "options", "answer", "analysis", "difficulty", "score", "category", "tags")


@dataclass(frozen=True)
class Options:
    """Limits and switches; each switch at its default keeps the established behaviour unless its comment says otherwise."""

    split_level: int = 2
    max_chars: int = 2000
    min_chars: int = 80
    max_per_section: int = 5
    mode: str = "auto"
    with_images: bool = False
    category: str | None = None
    similarity: float = 0.75
    near_duplicate: float = 0.85
    judge_stem_min: float = 0.0  # least stem ratio for a fuzzy match of JUDGE questions, whose options are all the same
    prune_locked: bool = False  # a locked question stays
    prune_matched: bool = False  # a question that was matched in this run stays
    position_share: float = 0.50
    high_share: float = 0.30
    high_sample: int = 20
    seed: int = 20261006
    batches: int = 6
