"""Tool-specific scoring rules as data."""

from __future__ import annotations

from dataclasses import dataclass, field

RANGE_OPERATORS = ("min", "max", "gt", "gte", "lt", "lte")


@dataclass(frozen=True)
class PlanRules:
    """Tool names and argument paths of the planning contract."""

    skipped_tools: tuple[str, ...] = ("get_weather", "web_search", "rag_query")
    direction_paths: tuple[str, ...] = ("parameters.x", "parameters.y", "parameters.yaw")
    action_tools: tuple[str, ...] = ("HumanAction", "RobotGesture", "RobotDance")
    query_tools: tuple[str, ...] = ("get_weather", "web_search", "rag_query", "robot_status")
    # tool -> (old selector, selector of the contract)
    selectors: dict = field(default_factory=lambda: {"RobotGesture": ("action", "gesture"), "RobotDance": ("action", "dance")})
    # tool -> paths the compatible score does not compare
    exempt: dict = field(default_factory=lambda: {
        "HumanAction": ("parameters.step", "parameters.distance", "parameters.degree"),
        "RobotDance": ("repeat",),
        "RobotGesture": ("repeat",),
    })
    # the compatible score compares directions by sign only for this tool and action
    directional: tuple[str, str] = ("HumanAction", "walk")


DEFAULT_RULES = PlanRules()
