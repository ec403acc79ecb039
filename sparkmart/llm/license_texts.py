"""License notices and texts that license scans look for."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Notice:
    """A text, and phrases that decide between it and texts nearly like it: of each entry one alternative (parted by |) must stand near."""

    text: str
    needs: tuple[str, ...] = ()


# License texts and notices as their publishers word them. Short licenses stand whole; of those that run to thousands
# of words the notice for source files and the opening passage do.
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_ONE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_TWO = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes "
    "software developed by the organization. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"


def _gnu(kind: str, version: str, program: str = "This program") -> tuple[Notice, ...]:
    """Notices of a GNU license: the sentence for a work, for a version and later ones, for one version only."""
    name = f"gnu {kind}general public license".lower()
    spoken = version.replace(".", " ")
    grant = f"{program} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License"
    return (
        Notice(f"This work is licensed under the GNU {kind}General Public License, version {version}.", (f"{name} version {spoken}",)),
        Notice(
            f"{grant} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
            (name, f"version {spoken} of the license"),
        ),
        Notice(f"{grant} version {version} as published by the Free Software Foundation.", (f"{name} version {spoken} as",)),
    )


def _commons(code: str, title: str) -> tuple[Notice, ...]:
    return (Notice(f"Licensed under CC {code} 4.0."), Notice(f"This work is licensed under a Creative Commons {title} 4.0 International License."))


TEMPLATES: dict[str, tuple[Notice, ...]] = {
    "0BSD": (Notice(_ISC_GRANT + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE", ("granted the software",)),),
    "AGPL-3.0": _gnu("Affero ", "3"),
    "Apache-1.1": (
        Notice(
            "The end-user documentation included with the redistribution, if any, must include the following acknowledgment: \"This product includes "
            "software developed by the Apache Software Foundation (http://www.apache.org/).\" Alternately, this acknowledgment may appear in the "
            "software itself, if and wherever such third-party acknowledgments normally appear."
        ),
    ),
    "Apache-2.0": (
        Notice("Licensed under the Apache License, Version 2.0."),
        Notice(
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
            "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
            "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
            "or implied."
        ),
        Notice(
            "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION "
            "1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 "
            "of this document."
        ),
    ),
    "Artistic-2.0": (
        Notice(
            "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed. "
            "The intent is that the Copyright Holder maintains some artistic control over the development of that Package while still keeping the "
            "Package available as open source and free software."
        ),
    ),
    "BSD-2-Clause": (Notice(_BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_END, ("with the distribution this software is",)),),
    "BSD-3-Clause": (
        Notice(_BSD_HEAD + _BSD_ONE + _BSD_TWO + "3. " + _BSD_NAMES + _BSD_END, ("with the distribution 3 neither|with the distribution neither|with the distribution 3 the name",)),
    ),
    "BSD-4-Clause": (
        Notice(_BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_ADVERTISING + "4. " + _BSD_NAMES + _BSD_END, ("all advertising materials mentioning",)),
    ),
    "BSL-1.0": (
        Notice(
            "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
            "covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
            "derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
        ),
        Notice("Distributed under the Boost Software License, Version 1.0."),
    ),
    "CC-BY-4.0": _commons("BY", "Attribution"),
    "CC-BY-NC-4.0": _commons("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _commons("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _commons("BY-SA", "Attribution-ShareAlike"),
    "CC0-1.0": (
        Notice("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
        Notice(
            "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the "
            "creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")."
        ),
    ),
    "EPL-1.0": (
        Notice(
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this "
            "distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
            ("license v1|license v 1|license 1 0",),
        ),
    ),
    "EPL-2.0": (
        Notice(
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
            "https://www.eclipse.org/legal/epl-2.0/",
            ("license 2 0|license v 2|license v2",),
        ),
    ),
    "GFDL-1.3": (
        Notice(
            "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or "
            "any later version published by the Free Software Foundation",
            ("license version 1 3",),
        ),
    ),
    "GPL-2.0": (
        *_gnu("", "2"),
        Notice(
            "GNU GENERAL PUBLIC LICENSE Version 2, June 1991. Everyone is permitted to copy and distribute verbatim copies of this license document, but "
            "changing it is not allowed. Preamble. The licenses for most software are designed to take away your freedom to share and change it.",
            ("license version 2 june",),
        ),
    ),
    "GPL-3.0": (
        *_gnu("", "3"),
        Notice(
            "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other "
            "practical works are designed to take away your freedom to share and change the works.",
            ("the gnu general public license is",),
        ),
    ),
    "ISC": (
        Notice(
            _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND "
            "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
            ("granted provided that",),
        ),
    ),
    "LGPL-2.1": (
        *_gnu("Lesser ", "2.1", "This library"),
        Notice(
            "This license, the Lesser General Public License, applies to some specially designated software packages--typically libraries--of the Free "
            "Software Foundation and other authors who decide to use it."
        ),
    ),
    "LGPL-3.0": (
        *_gnu("Lesser ", "3"),
        Notice(
            "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, "
            "supplemented by the additional permissions listed below."
        ),
    ),
    "MIT": (Notice("Released under the MIT License."), Notice(_MIT_GRANT + ", subject to the following conditions:", ("to do so subject",))),
    "MIT-0": (Notice(_MIT_GRANT + ". THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND", ("to do so the software is",)),),
    "MPL-1.1": (
        Notice(
            "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in "
            "compliance with the License.",
            ("license version 1 1",),
        ),
    ),
    "MPL-2.0": (Notice("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),),
    "PostgreSQL": (
        Notice(
            "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written "
            "agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."
        ),
    ),
    "Unlicense": (
        Notice(
            "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
            "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
        ),
    ),
    "WTFPL": (Notice("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION"),),
    "Zlib": (
        Notice(
            "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
            "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
            "applications, and to alter it and redistribute it freely, subject to the following restrictions:"
        ),
    ),
    "all-rights-reserved": (Notice("All rights reserved."),),
}
