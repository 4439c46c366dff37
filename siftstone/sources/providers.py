"""Clients of remote chat models, over plain HTTPS.

An endpoint is a value that tasks carry: it opens no connection until it is asked. Two
dialects are known, chat completions and messages; each says how a request is written and
how a reply is read. What goes wrong becomes a CallFailed, which tells the caller of the
client whether another try can help.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from .calls import FREE, check_free

# Where each kind of endpoint is and which variable holds its key.
BASES = {
    "openrouter": "https://openrouter.ai/api/v1",
    "openai": "https://api.openai.com/v1",
    "anthropic": "https://api.anthropic.com/v1",
}
KEYS = {"openrouter": "OPENROUTER_API_KEY", "openai": "OPENAI_API_KEY", "anthropic": "ANTHROPIC_API_KEY"}
MESSAGES_VERSION = "2023-06-01"
ERROR_TEXT = 300


class CallFailed(Exception):
    """A call without a usable answer; ``final`` says that asking again can't help."""

    def __init__(self, text: str, status: int | None = None, retry_after: float | None = None, final: bool = False):
        super().__init__(text[:ERROR_TEXT])
        self.status, self.retry_after, self.final = status, retry_after, final


def _seconds(value: str | None) -> float | None:
    try:
        return float(value) if value else None
    except ValueError:  # a date: the usual wait does
        return None


def _told(raw: bytes) -> str:
    """What an error body says, the innermost text first."""
    try:
        body = json.loads(raw)
    except ValueError:
        return raw.decode("utf-8", "replace")
    inner = body.get("error", body) if isinstance(body, dict) else body
    if not isinstance(inner, dict):
        return str(inner)
    upstream = inner.get("metadata")
    upstream = upstream.get("raw") if isinstance(upstream, dict) else None
    return str(upstream or inner.get("message") or inner)


def post_json(url: str, headers: Mapping[str, str], body: dict, timeout: float) -> dict:
    """The JSON reply to a JSON request."""
    data = json.dumps(body, ensure_ascii=False).encode()
    request = urllib.request.Request(url, data, {"content-type": "application/json", **headers}, method="POST")
    try:
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return json.loads(reply.read())
    except urllib.error.HTTPError as error:
        wait = _seconds(error.headers.get("retry-after")) if error.code == 429 else None
        raise CallFailed(f"{error.code}: {_told(error.read())}", error.code, wait) from error
    except (OSError, ValueError) as error:  # no connection, a timeout, or a reply that is no JSON
        raise CallFailed(f"connection: {error}") from error


@dataclass(frozen=True)
class Endpoint:
    """A model somewhere. ``schema`` is the JSON schema that answers keep."""

    kind: str
    model: str
    key: str = field(repr=False)
    base: str = ""
    fallbacks: tuple[str, ...] = ()
    effort: str | None = None
    max_tokens: int = 4096
    timeout: float = 120.0
    free_only: bool = False
    schema: dict | None = None
    post: Callable = post_json

    @property
    def label(self) -> str:
        return f"{self.kind}/{self.model}"

    def __call__(self) -> Callable[[str, str], tuple]:
        """A client: (system, user) to (text, served model, tokens in, tokens out)."""
        write, read = (_messages, _from_messages) if self.kind == "anthropic" else (_chat, _from_chat)

        def ask(system: str, user: str) -> tuple:
            path, headers, body = write(self, system, user)
            return read(self, self.post(self.base + path, headers, body, self.timeout))

        return ask


def _chat(at: Endpoint, system: str, user: str) -> tuple[str, dict, dict]:
    turns = [{"role": role, "content": text} for role, text in (("system", system), ("user", user))]
    body: dict = {"model": at.model, "messages": turns, "max_completion_tokens": at.max_tokens}
    if at.schema:
        body["response_format"] = {"type": "json_schema", "json_schema": {"name": "triage", "strict": True, "schema": at.schema}}
    if at.kind == "openrouter":
        body["provider"] = {"require_parameters": True}
        body |= {"models": [at.model, *at.fallbacks]} if at.fallbacks else {}
        body |= {"reasoning": {"effort": at.effort, "exclude": True}} if at.effort else {}
    elif at.effort:
        body["reasoning_effort"] = at.effort
    return "/chat/completions", {"authorization": f"Bearer {at.key}"}, body


def _from_chat(at: Endpoint, reply: dict) -> tuple:
    served = reply.get("model") or at.model
    if at.free_only and not served.endswith(FREE):
        raise CallFailed(f"answered by {served}, which is not free", final=True)
    choice = next(iter(reply.get("choices") or []), None)
    if choice is None:
        raise CallFailed("a reply without choices")
    text, why = (choice.get("message") or {}).get("content") or "", choice.get("finish_reason")
    if not text.strip():
        raise CallFailed(f"an empty answer ({why})", final=why == "content_filter")
    used = reply.get("usage") or {}
    return text, served, used.get("prompt_tokens") or 0, used.get("completion_tokens") or 0


def _messages(at: Endpoint, system: str, user: str) -> tuple[str, dict, dict]:
    body: dict = {"model": at.model, "max_tokens": at.max_tokens, "system": system, "messages": [{"role": "user", "content": user}]}
    if at.schema:
        body["output_config"] = {"format": {"type": "json_schema", "schema": at.schema}}
    return "/messages", {"x-api-key": at.key, "anthropic-version": MESSAGES_VERSION}, body


def _from_messages(at: Endpoint, reply: dict) -> tuple:
    if (why := reply.get("stop_reason")) in ("refusal", "max_tokens"):
        raise CallFailed(f"no whole answer ({why})", final=True)
    text = next((b.get("text") or "" for b in reply.get("content") or [] if b.get("type") == "text"), "")
    if not text.strip():
        raise CallFailed("an empty answer")
    used = reply.get("usage") or {}
    return text, reply.get("model") or at.model, used.get("input_tokens") or 0, used.get("output_tokens") or 0


def endpoint(name: str, env: Mapping[str, str] | None = None, free_only: bool = False, **settings) -> Endpoint:
    """The endpoint of a name like kind/model; its key and, if set, its base come from the environment."""
    env = os.environ if env is None else env
    kind, _, model = name.partition("/")
    if kind not in BASES or not model:
        raise ValueError(f"{name} is not one of {', '.join(BASES)} and a model")
    if not env.get(KEYS[kind]):
        raise ValueError(f"{KEYS[kind]} is not set")
    if free_only and kind == "openrouter":
        check_free([model, *settings.get("fallbacks", ())])
    base = env.get(KEYS[kind].replace("API_KEY", "BASE_URL")) or BASES[kind]
    return Endpoint(kind, model, env[KEYS[kind]], base.rstrip("/"), free_only=free_only and kind == "openrouter", **settings)
