"""Endpoints against a local server and a teacher against scripted replies; no network."""

import json
import re
import sys
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark import cloudpickle

from siftstone.functions import prompts
from siftstone.functions.contract import triage_schema
from siftstone.operators import batching, teacher
from siftstone.schemas import ENUMS
from siftstone.sources import calls
from siftstone.sources.providers import CallFailed, endpoint

# workers do not import tests, so the scripted replies travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = {"OPENROUTER_API_KEY": "k1", "OPENAI_API_KEY": "k2", "ANTHROPIC_API_KEY": "k3"}


def chat(text="{}", model="m:free", why="stop"):
    return {"model": model, "choices": [{"message": {"content": text}, "finish_reason": why}], "usage": {"prompt_tokens": 7, "completion_tokens": 2}}


def sent(name, reply, **settings):
    """What an endpoint posts, and what it makes of the reply."""
    posted = []

    def post(url, headers, body, timeout):
        posted.append((url, headers, body))
        return reply

    return endpoint(name, KEYS, post=post, **settings)()("be brief", "hello"), posted[0]


def test_chat_dialect():
    got, (url, headers, body) = sent("openrouter/a/m:free", chat("yes"), fallbacks=("b:free",), effort="low", schema=triage_schema(True))
    assert got == ("yes", "m:free", 7, 2)
    assert url == "https://openrouter.ai/api/v1/chat/completions" and headers["authorization"] == "Bearer k1"
    assert body["models"] == ["a/m:free", "b:free"] and body["reasoning"] == {"effort": "low", "exclude": True}
    assert body["provider"] == {"require_parameters": True} and body["response_format"]["json_schema"]["strict"]
    assert [m["role"] for m in body["messages"]] == ["system", "user"]
    _, (_, _, body) = sent("openai/gpt", chat(), effort="low")
    assert body["reasoning_effort"] == "low" and "models" not in body and "provider" not in body


def test_messages_dialect():
    reply = {"model": "served", "content": [{"type": "thinking"}, {"type": "text", "text": "yes"}], "usage": {"input_tokens": 5, "output_tokens": 1}}
    got, (url, headers, body) = sent("anthropic/m", reply, schema={"type": "object"})
    assert got == ("yes", "served", 5, 1)
    assert url.endswith("/v1/messages") and headers["x-api-key"] == "k3" and body["system"] == "be brief"
    assert body["output_config"]["format"]["schema"] == {"type": "object"} and "temperature" not in body


@pytest.mark.parametrize(
    "name, reply, settings, final",
    [
        ("openai/m", chat(" ", why="content_filter"), {}, True),
        ("openai/m", chat(""), {}, False),
        ("openai/m", {"choices": []}, {}, False),
        ("openrouter/m:free", chat(model="paid"), {"free_only": True}, True),
        ("anthropic/m", {"stop_reason": "refusal", "content": []}, {}, True),
        ("anthropic/m", {"stop_reason": "max_tokens", "content": [{"type": "text", "text": "{"}]}, {}, True),
        ("anthropic/m", {"content": []}, {}, False),
    ],
)
def test_replies_without_an_answer(name, reply, settings, final):
    with pytest.raises(CallFailed) as failed:
        sent(name, reply, **settings)
    assert failed.value.final is final and failed.value.status is None


def test_endpoints_need_a_key_and_a_known_kind():
    with pytest.raises(ValueError, match="OPENAI_API_KEY is not set"):
        endpoint("openai/m", {})
    with pytest.raises(ValueError, match="is not one of"):
        endpoint("elsewhere/m", KEYS)
    with pytest.raises(ValueError, match="only free"):
        endpoint("openrouter/m:free", KEYS, free_only=True, fallbacks=("paid",))
    assert "k1" not in repr(endpoint("openrouter/m", KEYS))
    assert endpoint("openai/m", KEYS | {"OPENAI_BASE_URL": "http://here/v2/"}).base == "http://here/v2"


def test_http_errors():
    """A busy server says when to come back; other errors tell their status and innermost text."""
    replies = [
        (429, {"retry-after": "3"}, {"error": {"message": "slow down"}}),
        (503, {"retry-after": "3"}, {"error": {"message": "outer", "metadata": {"raw": "upstream is down"}}}),
        (400, {}, {"error": "bad schema"}),
        (200, {}, chat("fine")),
    ]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            self.rfile.read(int(self.headers["content-length"]))
            status, headers, body = replies.pop(0)
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    ask = endpoint("openai/m", KEYS | {"OPENAI_BASE_URL": base}, timeout=10.0)()
    for status, wait, text in ((429, 3.0, "slow down"), (503, None, "upstream is down"), (400, None, "bad schema")):
        with pytest.raises(CallFailed, match=text) as failed:
            ask("s", "u")
        assert (failed.value.status, failed.value.retry_after) == (status, wait)
        assert calls.is_retryable(status) == (status != 400)
    assert ask("s", "u")[0] == "fine"
    server.shutdown()
    server.server_close()
    with pytest.raises(CallFailed, match="connection") as failed:
        ask("s", "u")
    assert failed.value.status is None and not failed.value.final


def test_requests_follow_the_schema_and_the_guide():
    plain = prompts.label_system()
    assert all(f'"{v}"' in plain for values in ENUMS.values() for v in values)
    guide = {"urgency": {"high": "a deadline is near", "": "one of three"}, "summary": {"": "one sentence"}}
    told = prompts.label_system(guide)
    assert told.startswith(plain) and told.endswith("\nurgency.high: a deadline is near\nurgency: one of three\nsummary: one sentence")
    assert prompts.generation_system({"intent": {"other": "no request"}}).endswith("\nintent.other: no request")
    assert prompts.generation_system(guide) == prompts.generation_system()
    for wrong in ({"urgency": {"soon": "x"}}, {"mood": {"": "x"}}):
        with pytest.raises(ValueError, match="the schema doesn't have"):
            prompts.label_system(wrong)


def scripted(url, headers, body, timeout):
    """Labels every ticket; gets urgency wrong until it is told, refuses batches with a bomb, loses the ticket "gone"."""
    system, user = (m["content"] for m in body["messages"])
    if "bomb" in user:
        raise CallFailed("400: not that", 400)
    if "Specifications" in user:
        specs = [json.loads(line) for line in user.splitlines() if line.startswith("{")]
        items = [{"id": s["id"], "text": f"I write about {s['topic']}"} for s in specs] + [{"id": "nobody", "text": "x"}, {"id": specs[0]["id"], "text": "again"}]
        items[-3]["text"] = " "
        return chat(json.dumps({"items": items}), "served:free")
    repairing = "Errors of the last answer" in user
    if repairing:
        assert '"urgency": "soon"' in user and "urgency: not an allowed value" in user
    urgency = "low" if repairing else "soon"
    made = []
    for name in re.findall('<ticket id="(.*?)">', user):
        if name != "gone":
            made.append({"intent": "other", "urgency": urgency if name == "b" else "low", "sentiment": "neutral", "product_area": "none", "order_id": None, "summary": "A text about nothing.", "id": name})
    return chat(json.dumps({"items": made}), "served:free")


PACE = {"spacing": 0.0, "retries": 1, "base": 0.0, "tasks": 2}


def remote(spark, folder, stage, budget):
    at = {"openrouter/m:free": endpoint("openrouter/m:free", KEYS, post=scripted, schema=triage_schema(True))}
    return teacher.RemoteTeacher(spark, at, stage, f"{folder}/cache", f"{folder}/calls.jsonl", "now", budget, **PACE)


def test_remote_labels_are_repaired_and_failures_told(spark, tmp_path):
    rows = [(0, "a", "one"), (1, "b", "mail me at x@y.com"), (2, "gone", "two"), (3, "d", "three"), (4, "e", "bomb")]
    tickets = spark.createDataFrame(rows, "pos long, id string, text string")

    def run(budget):
        ask = remote(spark, tmp_path, "label", budget)
        out = teacher.label_tickets(tickets, ["openrouter/m:free", "offline-b"], batch=4, repairs=1, ask=ask)
        return {r.id: r.labels for r in out.collect()}, ask

    got, ask = run(10)
    assert all(label[1].model == "offline-b" and label[1].triage for label in got.values())
    one = {k: v[0] for k, v in got.items()}
    assert one["a"].model == "served:free" and one["a"].triage.urgency == "low" and not one["a"].repaired
    assert one["b"].repaired and one["b"].triage.urgency == "low"
    assert (one["gone"].model, one["gone"].error, one["gone"].repaired) == ("openrouter/m:free", teacher.MISSING, False)
    assert one["e"].triage is None and one["e"].error == "request failed: 400: not that"
    ledger = spark.read.schema(calls.LEDGER).json(f"{tmp_path}/calls.jsonl")
    assert sorted((r.task, r.status, r["items"]) for r in ledger.collect()) == [("label", "error", 1), ("label", "ok", 4), ("repair", "ok", 2)]
    assert sorted(r["items"] for u in ask.usage for r in u.collect()) == [2, 4]
    # a second run replays its answers and has no calls left for the failed batch
    again, _ = run(3)
    assert {k: v[0] for k, v in again.items() if k != "e"} == {k: v for k, v in one.items() if k != "e"}
    assert again["e"][0].error == "request failed: budget is used up"


def test_remote_tickets(spark, tmp_path):
    seeds = batching.seed_matrix(spark, 6)
    made = teacher.ask_for_tickets(seeds, remote(spark, tmp_path, "generate", 9), "openrouter/m:free", per_call=4).collect()
    topics = {r.id: r.topic for r in seeds.collect()}
    assert len(made) == 4  # each of the two answers leaves one text blank
    assert all(r.text == f"I write about {topics[r.id]}" and r.seed["topic"] == topics[r.id] for r in made)
    assert {r.generator_model for r in made} == {"served:free"}
