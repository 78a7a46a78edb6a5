"""Row shapes, dataset specifications and fixed values shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# Ids and placeholders that must equal the ones of existing tables.
IGNORE_LABEL = -100
MAX_SUB_SEQUENCE = 2**63 - 1
IMAGE_TAG, VIDEO_TAG, AUDIO_TAG = "<image>", "<video>", "<audio>"
MEDIA = (
    (IMAGE_TAG, "image_url", "images"),
    (VIDEO_TAG, "video_url", "videos"),
    (AUDIO_TAG, "audio_url", "audios"),
)

TURN = "struct<role:string,content:string>"
TURNS = f"array<{TURN}>"
BLOCK = "struct<type:string,value:string>"
MESSAGE = f"struct<role:string,content:array<{BLOCK}>,loss_weight:double>"

COLUMN_KEYS = (
    "prompt", "query", "response", "history", "messages", "system", "tools",
    "images", "videos", "audios", "chosen", "rejected", "kto_tag",
)
TAG_KEYS = (
    "role_tag", "content_tag", "user_tag", "assistant_tag", "observation_tag", "function_tag", "system_tag",
)


@dataclass(frozen=True)
class DatasetSpec:
    """How one raw table maps to the canonical dialogue row."""

    source: str = ""
    formatting: str = "alpaca"
    ranking: bool = False
    file_format: str | None = None
    subset: str | None = None
    split: str = "train"
    folder: str | None = None
    num_samples: int | None = None
    size: int | None = None
    weight: float | None = None
    streaming: bool = False
    converter: str | None = None
    # columns
    prompt: str | None = "instruction"
    query: str | None = "input"
    response: str | None = "output"
    history: str | None = None
    messages: str | None = "conversations"
    system: str | None = None
    tools: str | None = None
    images: str | None = None
    videos: str | None = None
    audios: str | None = None
    chosen: str | None = None
    rejected: str | None = None
    kto_tag: str | None = None
    # tags
    role_tag: str | None = "from"
    content_tag: str | None = "value"
    user_tag: str | None = "human"
    assistant_tag: str | None = "gpt"
    observation_tag: str | None = "observation"
    function_tag: str | None = "function_call"
    system_tag: str | None = "system"
    extra: dict = field(default_factory=dict, compare=False)
