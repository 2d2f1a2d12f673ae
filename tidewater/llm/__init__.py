"""Training-data operators: licences, near and exact copies, neighbours, toxicity,
tokenizing, mixing, URL rules, language identification and chat formatting."""
