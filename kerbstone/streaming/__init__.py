"""The two continuous jobs: messages to bronze, bronze to silver and gold."""
