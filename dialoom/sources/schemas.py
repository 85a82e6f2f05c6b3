"""Schemas of conversations. Free-form payloads stay raw JSON strings, which alone keep them byte for byte."""

from __future__ import annotations

TURN = "struct<role string, content string, action string, tool_calls array<struct<name string, arguments string>>, tool_results string, context_block string>"
CONVERSATION = f"scenario_type string, language string, turns array<{TURN}>, user_settings_idx int"
ROLES = ("user", "assistant", "tool")
ACTIONS = ("text", "tool_call")
TALLY_ENTRY = "struct<entry_id int, food_name string, quantity double, unit string, carbs double>"
