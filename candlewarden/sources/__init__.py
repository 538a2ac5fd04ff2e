"""Raw text files in; canonical tables, manifests and digests out."""
