"""Declarative chat templates, compiled to native column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Text put around a conversation and around each of its messages."""

    user_prefix: str
    user_suffix: str
    assistant_prefix: str
    assistant_suffix: str
    start: str = ""
    end: str = ""
    generation_prompt: str = ""

    def render(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        def one(message: Column) -> Column:
            user = message["role"] == "user"
            return F.concat(
                F.when(user, F.lit(self.user_prefix)).otherwise(F.lit(self.assistant_prefix)),
                message["content"],
                F.when(user, F.lit(self.user_suffix)).otherwise(F.lit(self.assistant_suffix)),
            )

        body = F.array_join(F.transform(messages, one), "")
        closing = self.generation_prompt if add_generation_prompt else ""
        return F.concat(F.lit(self.start), body, F.lit(self.end + closing))


# Two public template forms.
CHATML = ChatTemplate(
    user_prefix="<|im_start|>user\n",
    user_suffix="<|im_end|>\n",
    assistant_prefix="<|im_start|>assistant\n",
    assistant_suffix="<|im_end|>\n",
    generation_prompt="<|im_start|>assistant\n",
)
INST = ChatTemplate(
    user_prefix="[INST] ",
    user_suffix=" [/INST]",
    assistant_prefix=" ",
    assistant_suffix="</s>",
    start="<s>",
)
