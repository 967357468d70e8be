"""DataFrame -> DataFrame operators: ``logs``, ``geo``, ``urls``, ``keywords``,
``activity``, ``versions``, ``identity``, ``wordcount``, ``joins``."""
