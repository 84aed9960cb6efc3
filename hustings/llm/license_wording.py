"""Sentences of licenses, as patterns over words in lower case joined by single spaces.

Each row is label, keyword (a word of every text it matches), level, weight, pattern.  Levels and weights are those of the named
forms: a sentence that only one license has weighs more than one that several share.
"""

from __future__ import annotations

# Wording of licenses.
WORDING = (
    # Permission notices of the MIT kind.
    ("mit", "substantial", 4, 0.90, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "deal", 4, 0.85, "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", "noninfringement", 3, 0.70, "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "tort", 3, 0.70, "whether in an action of contract tort or otherwise arising from out of or in connection with the software"),
    ("mit", "persons", 3, 0.60, "to permit persons to whom the software is furnished to do so"),
    ("x11", "consortium", 4, 0.90, "the name of the x consortium shall not be used in advertising"),
    ("json", "evil", 4, 0.95, "the software shall be used for good not evil"),
    ("ncsa", "contributors", 3, 0.60, "nor the names of its contributors may be used to endorse"),
    ("isc", "disclaims", 3, 0.80, "the author disclaims all warranties with regard to this software"),
    ("isc", "fee", 4, 0.85, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "loss", 3, 0.60, "resulting from loss of use data or profits whether in an action of contract negligence or other tortious action"),
    ("ntp", "representations", 3, 0.70, "makes no representations about the suitability (?:of )?this software for any purpose"),
    ("hpnd", "publicity", 3, 0.80, "not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission"),
    # The BSD kind.
    ("bsd", "binary", 4, 0.80, "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "retain", 4, 0.80, "redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", "endorse", 4, 0.85, "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "acknowledgement", 4, 0.90, "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", "negligence", 3, 0.60, "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software"),
    ("bsd", "substitute", 3, 0.60, "procurement of substitute goods or services loss of use data or profits or business interruption"),
    ("bsd-2-clause", "freebsd", 3, 0.60, "official policies either expressed or implied of the freebsd project"),
    ("bsd-3-clause-clear", "patent", 4, 0.90, "no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-patent", "perpetual", 3, 0.60, "each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide"),
    # Apache.
    ("apache-2.0", "compliance", 4, 0.95, "you may not use this file except in compliance with the license"),
    ("apache-2.0", "applicable", 4, 0.90, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "governing", 3, 0.80, "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "obtain", 3, 0.80, "you may obtain a copy of the license at"),
    ("apache-2.0", "notice", 3, 0.70, "if the work includes a notice text file as part of its distribution"),
    ("apache-2.0", "irrevocable", 3, 0.80, "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-2.0", "asf", 4, 0.95, "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-1.1", "includes", 4, 0.90, "this product includes software developed by the apache software foundation"),
    ("apache-1.1", "apache", 3, 0.80, "products derived from this software may not be called apache"),
    # The GNU licenses.
    ("gnu-gpl", "redistribute", 4, 0.90, "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gnu-gpl", "received", 4, 0.90, "you should have received a copy of the gnu general public license"),
    ("gnu-gpl-2", "either", 4, 0.90, "either version 2 of the license or (?:at your option )?any later version"),
    ("gnu-gpl-3", "either", 4, 0.90, "either version 3 of the license or (?:at your option )?any later version"),
    ("gnu-gpl-2", "version", 3, 0.70, "under the terms of version 2 of the gnu general public license"),
    ("gnu-gpl", "useful", 3, 0.80, "is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability"),
    ("gnu-gpl", "copyleft", 3, 0.70, "is a free copyleft license for software and other kinds of works"),
    ("gnu-gpl", "freedom", 3, 0.70, "the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change"),
    ("gnu-gpl-2", "temple", 3, 0.50, "free software foundation inc 59 temple place"),
    ("gnu-gpl", "franklin", 3, 0.50, "free software foundation inc 51 franklin st(?:reet)?"),
    ("gnu-gpl-3", "propagate", 3, 0.70, "to propagate a work means to do anything with it that without permission would make you directly or secondarily liable"),
    ("gnu-gpl-3", "tivoization", 2, 0.50, "tivoization"),
    ("gnu-gpl-3", "corresponding", 3, 0.70, "the corresponding source for a work in object code form means all the source code"),
    ("gnu-gpl", "exception", 3, 0.70, "as a special exception (?:the copyright holders|if you link this library|you may)"),
    ("gnu-gpl-classpath", "linking", 4, 0.90, "linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gnu-lgpl", "lesser", 4, 0.90, "under the terms of the gnu lesser general public license"),
    ("gnu-lgpl", "library", 4, 0.90, "under the terms of the gnu library general public license"),
    ("gnu-lgpl-2.1", "either", 4, 0.90, "either version 2 1 of the license or (?:at your option )?any later version"),
    ("gnu-lgpl", "combined", 3, 0.70, "you may convey a combined work under terms of your choice"),
    ("gnu-agpl", "affero", 4, 0.95, "under the terms of the gnu affero general public license"),
    ("gnu-agpl", "interacting", 4, 0.90, "prominently offer all users interacting with it remotely through a computer network"),
    ("gnu-fdl", "invariant", 4, 0.95, "with no invariant sections no front cover texts and no back cover texts"),
    ("gnu-fdl", "document", 3, 0.80, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gnu-all-permissive", "medium", 4, 0.90, "are permitted in any medium without royalty provided the copyright notice and this notice are preserved"),
    # Mozilla, Eclipse, Common Development and Distribution.
    ("mpl-2.0", "mozilla", 4, 0.95, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "mpl", 4, 0.90, "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "incompatible", 3, 0.80, "this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", "contents", 4, 0.90, "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", "alternatively", 3, 0.80, "alternatively the contents of this file may be used under the terms of"),
    ("mpl-1.1", "initial", 3, 0.70, "the initial developer of the original code is"),
    ("epl", "accompanying", 4, 0.90, "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "agreement", 3, 0.70, "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("epl-2.0", "secondary", 3, 0.80, "this source code may also be made available under the following secondary licenses"),
    ("edl-1.0", "eclipse", 4, 0.90, "are made available under the terms of the eclipse distribution license"),
    ("cddl", "subject", 4, 0.95, "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", "header", 3, 0.80, "when distributing covered code include this (?:cddl|license) header"),
    # Creative Commons and open data.
    ("cc0-1.0", "waiving", 4, 0.90, "has dedicated the work to the public domain by waiving all of his or her rights to the work"),
    ("cc0-1.0", "waived", 4, 0.90, "has waived all copyright and related or neighboring rights to"),
    ("cc0-1.0", "affirmer", 3, 0.80, "affirmer (?:hereby )?(?:overtly fully permanently|understands and acknowledges|disclaims)"),
    ("cc-attribution", "work", 3, 0.80, "this work is licensed under a creative commons attribution"),
    ("cc-attribution", "credit", 3, 0.70, "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-sharealike", "remix", 3, 0.70, "if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-noncommercial", "commercial", 3, 0.70, "you may not use the material for commercial purposes"),
    ("cc-noderivatives", "modified", 3, 0.70, "if you remix transform or build upon the material you may not distribute the modified material"),
    ("odbl-1.0", "database", 4, 0.90, "any rights in individual contents of the database are licensed under the database contents license"),
    ("pddl", "dedication", 3, 0.70, "is made available under the public domain dedication and license"),
    ("ogl-uk", "sector", 4, 0.90, "contains public sector information licensed under the open government licen[sc]e"),
    # Public domain and its like.
    ("unlicense", "unencumbered", 4, 0.95, "this is free and unencumbered software released into the public domain"),
    ("unlicense", "heirs", 3, 0.80, "we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("unlicense", "anyone", 3, 0.70, "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", 4, 0.95, "(?:you just )?do what the fuck you want to"),
    ("beerware", "beer", 4, 0.95, "you can buy me a beer in return"),
    ("sqlite-blessing", "blessing", 4, 0.95, "the author disclaims copyright to this source code in place of a legal notice here is a blessing"),
    ("0bsd", "purpose", 3, 0.60, "for any purpose with or without fee is hereby granted the software is provided as is"),
    ("public-domain", "domain", 3, 0.70, "this (?:file|code|software|work) is (?:hereby )?(?:in|placed in|released to|released into) the public domain"),
    ("public-domain", "government", 3, 0.70, "is a work of the (?:united states|u s) government"),
    # Single licenses.
    ("zlib", "misrepresented", 4, 0.95, "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered", 3, 0.80, "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "express", 3, 0.60, "this software is provided as is without any express or implied warranty"),
    ("libpng", "contributing", 3, 0.80, "the contributing authors and group 42 inc disclaim all warranties"),
    ("boost-1.0", "executable", 4, 0.90, "solely in the form of machine executable object code generated by a source language processor"),
    ("boost-1.0", "boost", 4, 0.95, "distributed under the boost software license version 1 0"),
    ("ofl-1.1", "font", 4, 0.95, "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "reserved", 3, 0.80, "with reserved font name"),
    ("artistic-2.0", "standard", 3, 0.80, "you may distribute verbatim copies of the source form of the standard version of this package"),
    ("artistic", "aggregate", 3, 0.80, "you may distribute this package in aggregate with other possibly commercial programs"),
    ("artistic", "perl", 4, 0.85, "you can redistribute it and or modify it under the same terms as perl itself"),
    ("python-2", "psf", 4, 0.90, "this license agreement is between the python software foundation psf and the individual or organization"),
    ("python-2", "beopen", 3, 0.80, "beopen python open source license agreement version 1"),
    ("php", "product", 4, 0.90, "this product includes php software freely available from"),
    ("openssl", "toolkit", 4, 0.95, "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "eric", 4, 0.90, "this product includes cryptographic software written by eric young"),
    ("postgresql", "regents", 3, 0.80, "the regents of the university of california"),
    ("ruby", "modify", 3, 0.60, "you may modify your copy of the software in any way provided that you do at least one of the following"),
    ("ms-pl", "accept", 3, 0.80, "if you use the software you accept this license if you do not accept the license do not use the software"),
    ("ms-pl", "contributor", 3, 0.60, "each contributor grants you a non exclusive worldwide royalty free copyright license"),
    ("ms-rl", "reciprocal", 3, 0.80, "reciprocal grants for any file you distribute that contains code from the software"),
    ("eupl", "eupl", 4, 0.95, "licensed under the eupl"),
    ("cecill", "french", 3, 0.80, "under french law and abiding by the rules of distribution of free software"),
    ("osl", "software", 3, 0.60, "licensed under the open software license version"),
    ("bsl", "production", 4, 0.90, "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl", "service", 4, 0.90, "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", "hosted", 4, 0.95, "you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "clause", 4, 0.95, "commons clause license condition|the commons clause"),
    ("vim", "charityware", 4, 0.95, "vim is charityware"),
    ("ijg", "jpeg", 4, 0.95, "this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype", 4, 0.95, "(?:by |c )?the freetype project"),
    ("unicode", "unicode", 3, 0.80, "unicode inc license agreement|a copy of the unicode data files"),
    ("w3c", "w3c", 3, 0.80, "w3c software (?:and document )?notice and license"),
    # Proprietary notices.
    ("proprietary", "trade", 3, 0.60, "(?:contains|are|is) (?:confidential information and )?trade secrets? of"),
    ("proprietary", "unauthorized", 3, 0.60, "unauthorized (?:copying|reproduction|use|disclosure)(?: or distribution)? of this (?:file|software|document|program)"),
    ("proprietary", "disassemble", 3, 0.60, "(?:you may not )?reverse engineer decompile or disassemble"),
    ("proprietary", "evaluation", 3, 0.50, "for (?:internal )?evaluation purposes only"),
    ("proprietary", "consent", 3, 0.50, "without the (?:prior|express) written consent of"),
    ("proprietary", "transmitted", 3, 0.60, "no part of this (?:publication|work|book|document) may be reproduced (?:stored in a retrieval system or )?(?:distributed or )?transmitted"),
)
